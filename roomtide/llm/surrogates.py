"""Surrogates for personal data, in DataFrame expressions only.

Detected entities are e-mail addresses, telephone, card and social security numbers, IPv4 and IPv6
addresses, secrets after password/token-like keys (in any letter case), and titled personal names:
after a title any number of capitalised names, initials and particles, over spaces or a line break;
in capitals, where a name has no visible end, three.  Each is replaced by a keyed, type-consistent
stand-in: digits by digits and letters by letters of the same script and case, the mention's own
punctuation and spacing, valid octets, a valid Luhn digit where the original had one, names of the
title's gender and of the same script.

Mentions are first brought to a canonical form (digits only, lower case), and the stand-in depends
on type, canonical form and key alone: the same entity gets the same stand-in in every document and
spelling (coreference).  Distinctness is checked over the whole corpus: entities of a type whose
stand-ins coincide, or equal a real entity, are drawn again until none does, and only those.  Only
entities that were drawn again need a lookup, by a join; all others are computed in place.
Initials and particles name nobody: an initial gets a keyed letter, a particle stays.

Defined results: null texts stay null, texts without entities stay as they are; a surname has one
stand-in whatever the title; a type whose format has no free value left after DRAWS draws gets a
keyed suffix instead of a repeated value; an empty table gives an empty result; other columns are
kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomtide.llm.names import unused
from roomtide.runtime import stage

DRAWS = 40
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
# Titles by gender, and particles inside names.
_MALE = ["Mr", "Herr", "Señor", "Sr", "Monsieur", "Sir", "Господин"]
_FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Mlle", "Госпожа"]
_NEUTRAL = ["Dr", "Prof", "Professor", "Доктор"]
_PARTICLES = "van|von|der|den|ter|ten|de|del|della|di|da|do|dos|du|la|le|el|al|bin|y|zu"
_TITLES = [*_MALE, *_FEMALE, *_NEUTRAL]
_GAP = r"(?:[ \t\p{Zs}]{0,8}\r?\n[ \t\p{Zs}]{0,8}|[ \t\p{Zs}]{1,8})"
_NAME = rf"(?:(?:{_PARTICLES}){_GAP})*+(?:\p{{Lu}}[\p{{L}}\p{{M}}'’-]+|\p{{Lu}}\.)"
_CAPITALS = rf"(?:\p{{Lu}}[\p{{Lu}}\p{{M}}'’-]+|\p{{Lu}}\.)(?![\p{{Ll}}])"
_HEX = "[0-9A-Fa-f]{1,4}"


def _any_of(titles: list[str], capitals: bool = False) -> str:
    """Alternatives, the longest first."""
    return "|".join(sorted((t.upper() if capitals else t for t in titles), key=len, reverse=True))


#: Country code and up to four groups of two digits or more.  Other international numbers have 7 to 15
#: digits in groups of any size; where more digits follow, what ends a group within 15 is taken.
_GROUPS = r"\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}"
#: Type -> pattern; the first that matches a mention names its type.
PATTERNS = {
    "email": r"(?<![\p{L}\p{M}\p{N}._%+-])[\p{L}\p{M}\p{N}._%+-]++@(?:[\p{L}\p{M}\p{N}-]+\.)+\p{L}{2,}",
    "secret": r"(?<=[=:\"']|[=:] )(?<=(?i:password|passwd|secret|token|api_key)[ ]{0,2}[=:][ ]{0,2}[\"']?)[A-Za-z0-9+/_-]{6,}",
    "ip": rf"(?=\d)(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.\d)",
    "ipv6": rf"(?=[0-9A-Fa-f:]*\d)(?<![\w:.])(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}(?::{_HEX}){{0,6}})?::(?:{_HEX}(?::{_HEX}){{0,6}})?)(?![\w:]|\.\d)",
    "card": r"(?=\d)(?<![\w+.-])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7})(?!\w|[.-]\d)",
    "ssn": r"(?=\d)(?<![\w.-])\d{3}-\d{2}-\d{4}(?!\w|[.-]\d)",
    "phone": r"(?=[\d(+])(?<![\w+.-])(?:(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?\d{3}[ .-]?|\d{3}[.-]\d{3}[ .-]?|\d{3} \d{3}[ .-])\d{4}"
             rf"|{_GROUPS}(?![ .-]?\d)|\+\d(?:[ .-]?\d){{6,14}}|{_GROUPS})(?!\w|[.-]\d)",
    "name": rf"(?=[MHFSDPГД])(?<!\p{{L}})(?:(?:{_any_of(_TITLES)})\.?(?:{_GAP}{_NAME})+"
            rf"|(?:{_any_of(_TITLES, True)})\.?(?:{_GAP}{_CAPITALS}){{1,3}})",
}
_ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Every mention holds one of these, follows a key, or holds digits in a row or after a plus; texts without any are not searched further.
_HINTS = ("@", *sorted({t[:4] for title in _TITLES for t in (title, title.upper())}))
_KEYS = r"(?i:passw|secret|token|api_key)"
_DIGITS = r"\d\d\d|\d\.\d|\+\d|:[0-9A-Fa-f]{0,4}:"
_ENDS = {("male", "latin"): ("on", "er", "ik", "o"), ("female", "latin"): ("a", "ina", "elle", "ia"),
         ("neutral", "latin"): ("is", "en", "u", "yn"), ("surname", "latin"): ("s", "n", "r", "t"),
         ("male", "cyrillic"): ("ан", "ор", "ил", "ей"), ("female", "cyrillic"): ("а", "ина", "ия", "ена"),
         ("neutral", "cyrillic"): ("ис", "ен", "у", "ын"), ("surname", "cyrillic"): ("к", "н", "р", "ш")}
#: 65 syllables to this power, times four ends, are more names than any corpus holds often.
_NAME_SYLLABLES = 4
#: Kinds whose stand-ins need not be distinct.
_COMMON = ("initial", "particle")
_SYLLABLES = {"latin": [c + v for c in "bdfgklmnprstv" for v in "aeiou"],
              "cyrillic": [c + v for c in "бвгдклмнпрст" for v in "аеиоу"]}


def _draw(key: str, kind: Column, canon: Column, attempt: Column, place: Column) -> Column:
    """Keyed non-negative number for one place of a stand-in."""
    digest = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, canon, attempt.cast("string"), place.cast("string")).cast("binary"), 256)
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")


def _pick(values: list[str], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (number % len(values) + 1).cast("int"))


def _characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string, the last digit counted once."""
    marks = F.reverse(_characters(digits))
    each = F.transform(marks, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        F.when(c.cast("int") * 2 > 9, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)))
    return F.aggregate(each, F.lit(0), lambda a, b: a + b)


def kind_of(mention: Column) -> Column:
    """Type of a whole mention."""
    tests = [(k, f"^(?:{p})$") for k, p in PATTERNS.items() if k != "secret"]
    out = reduce(lambda c, t: c.when(mention.rlike(t[1]), F.lit(t[0])), tests[1:], F.when(mention.rlike(tests[0][1]), F.lit(tests[0][0])))
    return out.otherwise(F.lit("secret"))


def _entities(mention: Column, kind: Column) -> Column:
    """Array of (kind, canon) that a mention holds: one, or one per part of a name."""
    # A country code is not part of a telephone number's identity.
    digits = F.regexp_replace(mention, r"\D", "")
    digits = F.when(kind == "phone", F.right(digits, F.lit(10))).otherwise(digits)
    script = F.when(mention.rlike(r"\p{IsCyrillic}"), F.lit("cyrillic")).otherwise(F.lit("latin"))
    def titled(titles: list[str]) -> Column:
        return mention.rlike(rf"^(?:{_any_of(titles)}|{_any_of(titles, True)})[.\s\p{{Z}}]")

    gender = F.when(titled(_FEMALE), F.lit("female")).when(titled(_NEUTRAL), F.lit("neutral")).otherwise(F.lit("male"))
    words = F.split(mention, _GAP)
    parts = F.slice(words, F.lit(2), F.size(words))
    named = F.transform(parts, lambda p, i: F.struct(
        F.when(p.rlike(rf"^(?:{_PARTICLES})$"), F.lit("particle")).when(p.rlike(r"^.\.$"), F.lit("initial")).otherwise(F.concat_ws(
            "/", F.when(i == F.size(parts) - 1, F.lit("surname")).otherwise(F.concat(F.lit("given/"), gender)), script)).alias("kind"),
        F.lower(p).alias("canon")))
    single = F.struct(kind.alias("kind"), F.when(kind.isin("card", "ssn", "phone"), digits).when(
        kind == "secret", mention).otherwise(F.lower(mention)).alias("canon"))
    return F.when(kind == "name", named).otherwise(F.array(single))


def stand_in(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """Canonical stand-in of a canonical entity."""
    def draw(place: Column) -> Column:
        return _draw(key, kind, canon, attempt, place)

    def letter(c: Column, i: Column) -> Column:
        number = draw(i)
        hexadecimal = (kind == "ipv6") | (kind == "secret") & canon.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")
        return (F.when(c.rlike("[0-9]"), (number % 10).cast("string"))
                .when(c.rlike("[a-f]") & hexadecimal, F.chr(97 + number % 6))
                .when(c.rlike("[A-F]") & hexadecimal, F.chr(65 + number % 6))
                .when(c.rlike("[a-z]"), F.chr(97 + number % 26))
                .when(c.rlike("[A-Z]"), F.chr(65 + number % 26))
                .when(c.rlike(r"\p{IsCyrillic}"), _pick(list("абвгдежзиклмнопрстуфхцчшэюя"), number))
                .when(c.rlike(r"[\p{L}\p{M}]"), F.chr(97 + number % 26))
                .when(c.rlike(r"\p{N}"), (number % 10).cast("string")).otherwise(c))

    def each(text: Column) -> Column:
        return F.array_join(F.transform(_characters(text), letter), "")

    # An address keeps its top-level domain, and example.* stays a reserved domain.
    tail = F.regexp_extract(canon, r"(\.(?:example\.)?\p{L}{2,})$", 1)
    email = F.concat(each(F.substring(canon, F.lit(1), F.length(canon) - F.length(tail))), tail)
    octets = F.concat_ws(".", (1 + draw(F.lit(0)) % 223).cast("string"), *[(draw(F.lit(i)) % 256).cast("string") for i in (1, 2, 3)])
    # Leading digits: a card keeps its first, others get no leading zero they did not have.
    digits = F.array_join(F.transform(_characters(canon), lambda c, i: F.when(
        (i == 0) & (kind == "card"), c).when(c == "0", (draw(i) % 10).cast("string")).otherwise((1 + draw(i) % 9).cast("string"))), "")
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    check = (10 - _luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10
    card = F.when(_luhn_sum(canon) % 10 == 0, F.concat(body, check.cast("string"))).otherwise(digits)

    def name(script: str) -> Column:
        base = F.concat(*[_pick(_SYLLABLES[script], draw(F.lit(i))) for i in range(_NAME_SYLLABLES)])
        end = {g: _pick(list(_ENDS[g, script]), draw(F.lit(9))) for g in ("female", "male", "neutral", "surname")}
        return F.concat(base, F.when(kind.startswith("given/female"), end["female"]).when(
            kind.startswith("given/neutral"), end["neutral"]).when(kind.startswith("given/"), end["male"]).otherwise(end["surname"]))

    made = (F.when(kind == "email", email).when(kind == "ip", octets).when(kind == "card", card)
            .when(kind.isin("ssn", "phone"), digits).when(kind.isin("secret", "ipv6", "initial"), each(canon))
            .when(kind == "particle", canon)
            .when(kind.endswith("cyrillic"), name("cyrillic")).otherwise(name("latin")))
    last = F.substring(F.sha2(F.concat_ws("\x1f", F.lit(key), kind, canon).cast("binary"), 256), 1, 16)
    return F.when((attempt >= DRAWS) & ~kind.isin(*_COMMON), F.concat(made, F.lit("-"), last)).otherwise(made)


def _formatted(mention: Column, kind: Column, made: Column) -> Column:
    """The canonical stand-in in the mention's format: its punctuation, or its letter case."""
    marks = _characters(mention)
    total = F.length(F.regexp_replace(mention, r"\D", ""))
    before = F.when((kind == "phone") & (total > 10), total - 10).otherwise(F.lit(0))
    rank = F.transform(marks, lambda c, i: F.length(
        F.regexp_replace(F.array_join(F.slice(marks, F.lit(1), i + 1), ""), r"\D", "")) - before)
    spaced = F.concat(F.array_join(F.zip_with(marks, rank, lambda c, r: F.when(
        c.rlike(r"\d") & (r > 0), F.substring(made, r, F.lit(1))).otherwise(c)), ""),
        F.substring(made, total - before + 1, F.lit(64)))
    cased = F.array_join(F.zip_with(_characters(made), marks, lambda m, c: F.when(
        c.rlike(r"\p{Lu}"), F.upper(m)).otherwise(F.coalesce(m, F.lit("")))), "")
    return F.when(kind.isin("card", "ssn", "phone"), spaced).when(kind.isin("email", "ipv6"), cased).otherwise(made)


def _found(mentions: Column) -> Column:
    """Array of (mention, kind, entities).  Each transform binds what the next one uses often."""
    kinds = F.transform(mentions, lambda m: F.struct(m.alias("mention"), kind_of(m).alias("kind")))
    return F.transform(kinds, lambda f: F.struct(
        f["mention"].alias("mention"), f["kind"].alias("kind"), _entities(f["mention"], f["kind"]).alias("entities")))


def _replacements(found: Column, attempts: Column | None, key: str) -> Column:
    """What stands in for each mention; ``attempts`` maps kind + canon to a later draw."""
    def drawn(e: Column) -> Column:
        number = F.lit(0)
        if attempts is not None:
            number = F.coalesce(F.try_element_at(attempts, F.concat_ws("\x1f", e["kind"], e["canon"])), F.lit(0))
        return stand_in(e["kind"], e["canon"], number, key)

    made = F.transform(found, lambda f: F.struct(
        f["mention"].alias("mention"), f["kind"].alias("kind"), F.transform(f["entities"], drawn).alias("made")))

    def formatted(f: Column) -> Column:
        words = F.split(f["mention"], _GAP)
        gaps = F.regexp_extract_all(f["mention"], F.lit(_GAP), F.lit(0))
        cased = F.zip_with(f["made"], F.slice(words, F.lit(2), F.size(words)), lambda made, word: F.when(
            word == F.lower(word), made).when((word == F.upper(word)) & (F.length(word) > 1), F.upper(made)).otherwise(F.initcap(made)))
        named = F.concat(words[0], F.array_join(F.zip_with(gaps, cased, lambda gap, name: F.concat(gap, name)), ""))
        return F.when(f["kind"] == "name", named).otherwise(_formatted(f["mention"], f["kind"], f["made"][0]))

    return F.transform(made, formatted)


def _hinted(text: Column) -> Column:
    """Whether a text may hold a mention; true for every text that does."""
    return reduce(lambda a, b: a | b, [text.contains(h) for h in _HINTS], text.rlike(f"{_DIGITS}|{_KEYS}"))


def _mentions(text: Column) -> Column:
    """All mentions of a text; texts without a hint are not searched further."""
    return F.when(_hinted(text), F.regexp_extract_all(text, F.lit(_ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))


def entities(documents: DataFrame) -> DataFrame:
    """Distinct (kind, canon) of all texts whose stand-ins must be distinct."""
    mentions = documents.select(F.explode(_mentions(F.col("text").cast("string"))).alias("mention")).distinct()
    found = mentions.select(_found(F.array("mention"))[0]["entities"].alias("e"))
    return found.select(F.explode("e").alias("e")).select("e.*").where(~F.col("kind").isin(*_COMMON)).distinct()


def attempts(found: DataFrame, key: str) -> DataFrame:
    """kind, canon, attempt, made: stand-ins that are distinct and no real entity of their kind.

    Every round draws again only what collided in the last one: with a real entity, with a
    stand-in that was accepted before, or with another one of the round.
    """
    base = stage(found)
    real = base.select("kind", F.col("canon").alias("made"))
    drawn, accepted = base.withColumn("attempt", F.lit(0)), None
    order = Window.partitionBy("kind", "made").orderBy("canon")
    for _ in range(DRAWS + 1):
        made = drawn.withColumn("made", stand_in(F.col("kind"), F.col("canon"), F.col("attempt"), key))
        made = stage(made.withColumn("again", F.row_number().over(order) > 1))
        # The few stand-ins of a round select what they meet in the large tables, not the other way.
        wanted = made.select("kind", "made")
        met = real if accepted is None else real.unionByName(accepted.select("kind", "made"))
        taken = met.join(wanted, ["kind", "made"], "left_semi").distinct().withColumn("met", F.lit(True))
        judged = stage(made.join(taken, ["kind", "made"], "left").select(
            "kind", "canon", "attempt", "made", (F.col("again") | F.col("met").isNotNull()).alias("again")))
        fine = judged.where(~F.col("again")).drop("again")
        accepted = fine if accepted is None else accepted.unionByName(fine)
        drawn = judged.where("again").select("kind", "canon", (F.col("attempt") + 1).alias("attempt"))
        if drawn.isEmpty():
            break
    return accepted


def replaced(documents: DataFrame, key: str = "surrogate-key-1") -> DataFrame:
    """All columns with the text's entities replaced, plus n_entities."""
    later = stage(attempts(entities(documents), key).where("attempt > 0"))
    kept = [c for c in documents.columns if c != "n_entities"]
    mentions, held, same = unused(kept, "mentions", "held", "same")
    text = F.col("text").cast("string")
    split = documents.select(*kept, _mentions(text).alias(mentions))
    lookup = None
    if not later.isEmpty():
        # Texts that hold such an entity get a map of their own; the key is their content.
        some = documents.select(text.alias("text")).select(F.xxhash64("text").alias("print"), _mentions(F.col("text")).alias("m"))
        found = some.select("print", F.explode("m").alias("mention")).distinct().select(
            "print", F.explode(_found(F.array("mention"))[0]["entities"]).alias("e")).select("print", "e.*").distinct()
        maps = found.join(later, ["kind", "canon"]).groupBy(F.col("print").alias(same)).agg(F.map_from_entries(F.collect_list(
            F.struct(F.concat_ws("\x1f", "kind", "canon"), "attempt"))).alias(held))
        # Texts without a mention need no map; the join leaves their key null, and spreads them.
        own = F.when(F.size(mentions) > 0, F.xxhash64(text))
        split = split.join(maps, own == F.col(same), "left").drop(same)
        lookup = F.col(held)
    gaps = F.split(text, _ANY, -1)
    news = _replacements(_found(F.col(mentions)), lookup, key)
    whole = F.concat(gaps[0], F.array_join(F.zip_with(news, F.slice(gaps, F.lit(2), F.size(mentions)),
                                                      lambda a, b: F.concat(a, b)), ""))
    out = {"text": F.when(F.size(mentions) > 0, whole).otherwise(text)}
    return split.select(*[out[c].alias(c) if c in out else c for c in kept], F.size(mentions).cast("long").alias("n_entities"))
