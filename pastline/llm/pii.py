"""Personal data replaced by keyed surrogates.

Entities (e-mail, IBAN, social security number, IPv4 and IPv6, card, phone,
titled names) get replacements drawn from SHA-256 of a key, the kind and the
entity's canonical form: the same person or number has the same surrogate
everywhere, whatever its writing. A replacement keeps the kind and format
(punctuation, letter case, lengths, Luhn and IBAN check digits, country codes,
top-level domain), the script of a name and the gender of a given name, as the
titles it occurs with tell it (none where they differ or tell none).

Given names and surnames are one name space: a name has one surrogate in
whatever place it stands. A name found behind a title is replaced wherever it
stands in that text as a word of its own in the same writing, so a person is
not named beside the surrogate.

Distinctness is checked over the whole corpus: no two entities of a kind may
share a surrogate and no surrogate may be an entity that occurs. An entity
that loses such a check draws again, in rounds of the losers alone, until none
does. Names and the local parts of e-mails get longer from draw ``LENGTHEN``
on, so that they never run out of values; numbers keep their length, and only
a kind with more entities than its format has values ends the query.

Built-in functions only: one pass finds the entities, their distinct forms
are checked, and one pass rewrites the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pastline.llm.common import LOWER, UPPER, bind, lower_ascii, stored, text_key

KEY = "surrogate-key-0"
LENGTHEN = 4
# fixed values: what counts as an entity, in order of preference
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
IP = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])"
IP6 = r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){2,6}:(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,4})?)(?![0-9A-Za-z:]|\.[0-9])"
CARD = r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){12,18}(?![0-9])"
PHONE = r"(?<![0-9A-Za-z+.])(?:\+[0-9]{8,15}|(?:\+[0-9]{1,3}[\x20.-][0-9]{1,2}|0[1-9])(?:[\x20.-][0-9]{2}){4}|[2-9][0-9]{2}[2-9][0-9]{6})(?![0-9A-Za-z])|(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{2,4}\)[\x20.-]?|[0-9]{2,4}[\x20.-])[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])"
MALE = ("Mr", "Herr", "Señor", "Sr", "Monsieur", "Г-н", "Господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Г-жа", "Госпожа")
NEUTRAL = ("Dr", "Prof")
TITLE = "(?:" + "|".join(sorted(MALE + FEMALE + NEUTRAL, key=len, reverse=True)) + r")\.?\x20"
NAME = r"(?<!\p{L})" + TITLE + r"\p{Lu}[\p{L}'-]+(?:\x20\p{Lu}[\p{L}'-]+)?"
ENTITY = "|".join((EMAIL, IBAN, SSN, IP, IP6, CARD, PHONE, NAME))
#: Letters that replace each other in names, by script and sound.
SOUNDS = ("aeiou", "bcdfghjklmnpqrstvwxyz", "аеиоуыэюя", "бвгджзклмнпрстфхцчш", "αεηιουω", "βγδζθκλμνξπρστφχψ", "áéíóúàèìòùâêîôûäëïöü", "çñß")
#: Letters that replace a name's other letters, by script; those of a script not listed become Latin.
SCRIPTS = {"Cyrillic": SOUNDS[2] + SOUNDS[3], "Greek": SOUNDS[4] + SOUNDS[5], "Armenian": "աբգդեզէըթժիլխծկհձղճմյնշոչպջռսվտրցւփք", "Georgian": "აბგდევზთიკლმნოპჟრსტუფქღყშჩცძწჭხჯჰ"}
EMPTY = "array<struct<kind:string,canon:string,gender:string,surface:string>>"
#: Values of the number formats: what is drawn of social security, IPv4 and phone numbers. Cards and IBANs have theirs per length.
ROOM = {"ssn": 10 ** 8, "ip": 223 * 256 * 256 * 254, "phone": 8 * 10 ** 6}


def _whole(m: Column, pattern: str) -> Column:
    return m.rlike("^(?:" + pattern + ")$")


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def entities_of(m: Column) -> Column:
    """The entities of a match as (kind, canon, gender, surface): one, or the parts of a titled name."""
    one = lambda kind, canon: F.array(F.struct(F.lit(kind).alias("kind"), canon.alias("canon"), F.lit("").alias("gender"), m.alias("surface")))
    names = F.split(F.regexp_replace(m, "^" + TITLE, ""), " ")
    gender = F.when(m.rlike("^(?:" + "|".join(MALE) + r")\.?\x20"), "m").when(m.rlike("^(?:" + "|".join(FEMALE) + r")\.?\x20"), "f").otherwise("")
    titled = F.transform(names, lambda x, i: F.struct(F.lit("name").alias("kind"), F.lower(x).alias("canon"),
                                                      F.when(i < F.size(names) - 1, gender).otherwise("").alias("gender"), x.alias("surface")))
    return (F.when(m.contains("@"), one("email", lower_ascii(m)))
            .when(_whole(m, IP6), one("ip6", F.lower(m)))
            .when(m.rlike("^[A-Z]{2}[0-9]{2}"), one("iban", F.replace(m, F.lit(" "), F.lit(""))))
            .when(m.rlike(r"^\p{L}"), titled)
            .when(_whole(m, SSN), one("ssn", _digits(m)))
            .when(_whole(m, IP), one("ip", m))
            .when(_whole(m, CARD), one("card", _digits(m)))
            .otherwise(one("phone", F.right(F.regexp_replace(_digits(F.regexp_replace(m, r"^\+[0-9]{1,3}[\x20.-]", "")), "^0", ""), F.lit(10)))))


def _draw(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), kind, canon, attempt.cast("string")), 512)


def _byte(h: Column, i: Column) -> Column:
    """Byte i (from 0, around the end) of a hex digest."""
    return F.conv(F.substr(h, 2 * F.pmod(i, F.lit(64)) + 1, F.lit(2)), 16, 10).cast("int")


def _restyled(s: Column, h: Column, classes: tuple[str, ...]) -> Column:
    """Each character of a class replaced by a drawn one of the class; all others stay."""
    def one(c: Column, i: Column) -> Column:
        out = c
        for letters in classes:
            pick = F.substr(F.lit(letters), F.pmod(_byte(h, i), F.lit(len(letters))) + 1, F.lit(1))
            out = F.when(F.position(c, F.lit(letters)) > 0, pick).otherwise(out)
        return out
    return F.array_join(F.transform(F.split(s, ""), one), "")


def _other_letters(s: Column, h: Column) -> Column:
    """The letters of a name outside ``SOUNDS`` replaced by drawn ones of their script."""
    def one(c: Column, i: Column) -> Column:
        pick = lambda letters: F.substr(F.lit(letters), F.pmod(_byte(h, i), F.lit(len(letters))) + 1, F.lit(1))
        out = pick(LOWER)
        for script, letters in SCRIPTS.items():
            out = F.when(c.rlike(r"^\p{Is" + script + "}$"), pick(letters)).otherwise(out)
        return F.when(c.rlike(r"^\p{L}$") & (F.position(c, F.lit("".join(SOUNDS))) == 0), out).otherwise(c)
    return F.array_join(F.transform(F.split(s, ""), one), "")


def _luhn(body: Column) -> Column:
    """The check digit that follows ``body``."""
    n = F.length(body)
    total = F.aggregate(F.transform(F.split(body, ""), lambda c, i: bind(
        c.cast("int") * F.when(F.pmod(n - i, F.lit(2)) == 1, 2).otherwise(1), lambda x: F.when(x > 9, x - 9).otherwise(x))), F.lit(0), lambda a, x: a + x)
    return F.pmod(10 - F.pmod(total, F.lit(10)), F.lit(10)).cast("string")


def _iban_check(country: Column, body: Column) -> Column:
    """The two check digits of an IBAN: 98 less the remainder by 97 of body, country and 00, letters read as 10 to 35."""
    chars = F.split(F.concat(body, country, F.lit("00")), "")
    rest = F.aggregate(chars, F.lit(0), lambda r, c: F.when(c.rlike("[0-9]"), F.pmod(r * 10 + F.coalesce(F.try_to_number(c, F.lit("9")).cast("int"), F.lit(0)), F.lit(97)))
                       .otherwise(F.pmod(r * 100 + F.ascii(c) - 55, F.lit(97))))
    return F.lpad((98 - rest).cast("string"), 2, "0")


def surrogate(kind: Column, canon: Column, attempt: Column, key: str = KEY, gender: Column | None = None) -> Column:
    """The canonical form that replaces a canonical form; ``gender`` ('m', 'f' or '') decides a name's ending."""
    gender = F.lit("") if gender is None else gender
    def build(h: Column) -> Column:
        digits = F.translate(h, "abcdef", "012345")
        n = F.length(canon)
        some = F.substr(digits, F.lit(1), n)
        lead = F.translate(F.substr(digits, F.lit(1), F.lit(1)), "01", "23")
        octet = lambda i, most, low: (F.pmod(_byte(h, F.lit(i)) * 256 + _byte(h, F.lit(i + 8)), F.lit(most)) + low).cast("string")
        body = F.concat(F.left(canon, F.lit(1)), F.substr(digits, F.lit(2), n - 2))
        local, domain = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
        top = F.substring_index(domain, ".", -1)
        host = F.substr(domain, F.lit(1), F.length(domain) - F.length(top))
        # one draw per domain, so that colleagues stay colleagues
        host_draw = _draw(F.lit("domain"), domain, F.lit(0), key)
        letters = (LOWER, "0123456789")
        # other letters first: what replaces them is then drawn by sound, like the rest
        drawn = _restyled(_other_letters(canon, h), h, SOUNDS)
        size = F.greatest(F.lit(0), F.floor((attempt - LENGTHEN) / 4) + 1).cast("int")
        hexes = F.right(h, size)
        extra = F.when(size == 0, "").when(canon.rlike(r"\p{IsCyrillic}$"), F.translate(hexes, "0123456789abcdef", SOUNDS[3][:16])).otherwise(
            F.translate(hexes, "0123456789abcdef", "bcdfghklmnprstvz"))
        longer = lambda x: F.concat(F.substr(x, F.lit(1), F.length(x) - 1), extra, F.right(x, F.lit(1)))
        end = F.right(canon, F.lit(1))
        gendered = lambda d: F.concat(F.substr(d, F.lit(1), n - 1), F.when(F.position(end, F.lit(SOUNDS[2] + SOUNDS[3])) > 0, F.when(gender == "f", "а").otherwise("н"))
                            .when(F.position(end, F.lit(SOUNDS[0] + SOUNDS[1])) > 0, F.when(gender == "f", "a").otherwise("o")).otherwise(F.right(d, F.lit(1))))
        return (F.when(kind == "email", F.concat(_restyled(local, h, letters), extra, F.lit("@"), _restyled(host, host_draw, letters), top))
                .when(kind == "iban", bind(_restyled(F.substr(canon, F.lit(5)), h, (UPPER, "0123456789")), lambda x: F.concat(
                    F.left(canon, F.lit(2)), _iban_check(F.left(canon, F.lit(2)), x), x)))
                .when(kind == "ip6", _restyled(canon, h, ("0123456789abcdef",)))
                .when(kind == "ssn", F.concat(F.lit("9"), F.substr(digits, F.lit(2), F.lit(8))))
                .when(kind == "ip", F.concat_ws(".", octet(0, 223, 1), octet(1, 256, 0), octet(2, 256, 0), octet(3, 254, 1)))
                .when(kind == "card", F.concat(body, _luhn(body)))
                .when(kind == "phone", F.concat(lead, F.substr(some, F.lit(2))))
                .otherwise(bind(drawn, lambda d: bind(F.when(gender != "", gendered(d)).otherwise(d), longer))))
    return bind(_draw(kind, canon, attempt, key), build)


def _like(s: Column, shape: Column) -> Column:
    """``s`` in the letter case of ``shape``, position by position."""
    return F.array_join(F.transform(F.split(s, ""), lambda c, i: bind(
        F.substr(shape, i + 1, F.lit(1)), lambda x: F.when((x == F.upper(x)) & (x != F.lower(x)), F.upper(c)).otherwise(c))), "")


def _digits_into(shape: Column, digits: Column) -> Column:
    """The last digits of ``shape`` replaced by ``digits``, in order; all else stays."""
    chars = F.split(shape, "")
    skip = F.length(_digits(shape)) - F.length(digits)
    filled = F.aggregate(chars, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), lambda a, c: F.when(
        c.rlike("[0-9]"), F.struct(F.concat(a.out, F.when(a.at < skip, c).otherwise(F.substr(digits, a.at - skip + 1, F.lit(1)))).alias("out"), (a.at + 1).alias("at"))
    ).otherwise(F.struct(F.concat(a.out, c).alias("out"), a.at.alias("at"))), lambda a: a.out)
    return filled


DRAWS = "map<string,struct<attempt:int,gender:string>>"


def rewritten(m: Column, draws: Column, key: str = KEY) -> Column:
    """A match with its entities replaced; ``draws`` maps ``kind|canon`` to draw and gender where they are not 0 and none."""
    def one(es: Column) -> Column:
        first = F.get(es, F.lit(0))
        title = F.regexp_extract(m, "^" + TITLE, 0)
        name = F.concat(title, F.array_join(F.transform(es, lambda e: _like(_replaced(e, draws, key), e.surface)), " "))
        spaced = bind(_replaced(first, draws, key), lambda s: F.array_join(F.transform(F.split(m, ""), lambda c, i: F.when(c == " ", c).otherwise(
            F.substr(s, i + 1 - F.length(F.regexp_replace(F.substr(m, F.lit(1), i), "[^ ]", "")), F.lit(1)))), ""))
        return (F.when(first.kind.isin("email", "ip6"), _like(_replaced(first, draws, key), m))
                .when(first.kind == "ip", _replaced(first, draws, key))
                .when(first.kind == "iban", spaced)
                .when(first.kind.isin("ssn", "card", "phone"), _digits_into(m, _replaced(first, draws, key)))
                .otherwise(name))
    return bind(entities_of(m), one)


def _replaced(e: Column, draws: Column, key: str) -> Column:
    return bind(F.element_at(draws, F.concat_ws("|", e.kind, e.canon)), lambda d: surrogate(
        e.kind, e.canon, F.coalesce(d.attempt, F.lit(0)), key, F.coalesce(d.gender, F.lit(""))))


def mentions_replaced(text: Column, names: Column, draws: Column, key: str) -> Column:
    """``text`` with the ``names`` of its document replaced where they stand as words of their own, in the same writing."""
    def one(t: Column, e: Column) -> Column:
        return F.regexp_replace(t, F.concat(F.lit(r"(?<![\p{L}\p{N}@.])"), e.surface, F.lit(r"(?![\p{L}\p{N}@])")), _like(_replaced(e, draws, key), e.surface))
    return F.aggregate(names, text, one)


def assignment(entities: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, canon, gender, attempt): each distinct entity with the gender its titles agree on and the draw that is free.

    In a round the entities without a surrogate draw; a draw that is taken,
    that another of the round with a smaller canonical form has drawn too, or
    that is an entity itself, is lost. Raises if a number format has fewer
    values than entities.
    """
    known = entities.groupBy("kind", "canon").agg(F.max(F.col("gender") == "m").alias("m"), F.max(F.col("gender") == "f").alias("f"))
    gender = F.when(F.col("m") & ~F.col("f"), "m").when(F.col("f") & ~F.col("m"), "f").otherwise("")
    known = stored(known.select("kind", "canon", gender.alias("gender")), "pii-entities")
    for r in known.groupBy("kind").count().collect():  # one row per kind
        if r["count"] > ROOM.get(r["kind"], r["count"]):
            raise ValueError(f"{r['count']} entities of kind {r['kind']}, but only {ROOM[r['kind']]} values")
    real = known.select("kind", F.col("canon").alias("drawn"))
    open_, won = known.withColumn("attempt", F.lit(0)), None
    while True:
        drawn = stored(open_.withColumn("drawn", surrogate(F.col("kind"), F.col("canon"), F.col("attempt"), key, F.col("gender"))), "pii-drawn")
        free = drawn.join(real, ["kind", "drawn"], "left_anti")
        if won is not None:
            free = free.join(won.select("kind", "drawn"), ["kind", "drawn"], "left_anti")
        # of equal draws the smallest canonical form keeps it
        owner = free.groupBy("kind", "drawn").agg(F.min(F.struct("canon", "gender", "attempt")).alias("x"))
        now = stored(owner.select("kind", "drawn", "x.canon", "x.gender", "x.attempt"), "pii-won")
        won = now if won is None else won.unionByName(now)
        lost = stored(drawn.join(now.select("kind", "canon"), ["kind", "canon"], "left_anti"), "pii-lost")
        if lost.isEmpty():
            return won.select("kind", "canon", "gender", "attempt")
        open_ = lost.select("kind", "canon", "gender", (F.col("attempt") + 1).alias("attempt"))


def surrogate_pii(docs: DataFrame, key: str = KEY) -> DataFrame:
    """One row per row of ``docs`` (reads doc_id and text; others are ignored).

    Columns: doc_id, text (entities replaced), n_entities. Null texts stay
    null, texts without an entity stay as they are. Repeated rows are
    rewritten alike. Equal entities have equal surrogates in all documents and
    unequal ones unequal surrogates; raises if a number format has no room for
    that. ``n_entities`` counts the matches; later mentions of a name without
    title are replaced beside them.
    """
    flat = F.flatten(F.transform(F.regexp_extract_all("text", F.lit(ENTITY), F.lit(0)), entities_of))
    found = stored(docs.select("doc_id", text_key().alias("text_key"), F.array_distinct(F.coalesce(flat, F.array().cast(EMPTY))).alias("found"))
                   .filter(F.size("found") > 0), "pii-found")
    each = found.select("doc_id", "text_key", F.inline("found"))
    again = assignment(each, key)
    again = again.filter("attempt > 0 or gender <> ''")
    draws = each.select("doc_id", "text_key", "kind", "canon").distinct().join(again, ["kind", "canon"]).groupBy("doc_id", "text_key").agg(
        F.map_from_entries(F.collect_set(F.struct(F.concat_ws("|", "kind", "canon").alias("k"), F.struct("attempt", "gender").alias("v")))).alias("draws"))
    draws = stored(draws.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "draws"), "pii-draws")
    joined = docs.select("doc_id", "text").join(draws, F.col("doc_id").eqNullSafe(F.col("__id")) & (text_key() == F.col("__key")), "left")
    draw = F.coalesce("draws", F.create_map().cast(DRAWS))

    def rebuilt(found: Column) -> Column:
        names = F.array_distinct(F.transform(F.filter(F.flatten(F.transform(found, entities_of)), lambda e: e.kind == "name"),
                                             lambda e: F.struct(e.kind.alias("kind"), e.canon.alias("canon"), F.lit("").alias("gender"), e.surface.alias("surface"))))

        def joined_up(names: Column) -> Column:
            gap = lambda x: F.when(F.size(names) > 0, mentions_replaced(x, names, draw, key)).otherwise(x)
            return F.array_join(F.transform(F.split("text", ENTITY, -1), lambda x, i: F.concat(gap(x), F.coalesce(rewritten(F.get(found, i), draw, key), F.lit("")))), "")
        return F.struct(F.when(F.size(found) > 0, bind(names, joined_up)).otherwise(F.col("text")).alias("text"), F.coalesce(F.size(found), F.lit(0)).alias("n"))

    made = joined.select("doc_id", "text", bind(F.regexp_extract_all("text", F.lit(ENTITY), F.lit(0)), rebuilt).alias("made"))
    return made.select("doc_id", F.col("made.text").alias("text"), F.when(F.col("text").isNull(), 0).otherwise(F.col("made.n")).cast("long").alias("n_entities"))
