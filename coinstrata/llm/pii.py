"""Personal data: detected entities get keyed surrogates of the same kind and form.

A mention (as written) has one or two parts, each an entity: a type and a canonical form,
so that "+1 (555) 010-2030" and "+15550102030" are one phone. The surrogate of an entity
is a function of the key, the type and the canonical form (HMAC-SHA256), letter by letter
within a class: digits become digits, vowels vowels of the script, and so on; cards keep
their check digit right, addresses stay addresses, given names keep a typical ending of
the gender that the title tells. A mention is written again in its own form: blanks,
brackets, capitals.

Entities of the whole corpus are checked against each other: two of them never share a
surrogate, and none gets a real entity of the corpus; whoever collides tries again with
the next attempt number. So distinct entities stay distinct and the same one stays the
same in all documents. A name that stands without its title later in a text is replaced
there too.

Everything is built-in functions. Texts that cannot hold a mention (no address sign, no
number, no title, ...) are told by cheap tests before the patterns, each text with a mention
is written once, and only their digests and mentions are shuffled.
"""

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinstrata.llm.common import Stages, carried
from coinstrata.llm.quality import let

# Titles that tell a gender, those that may follow them, words inside names,
# and what stands before a secret.
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "Mme", "Signora", "Госпожа", "Κυρία"]
MALE = ["Mr", "Herr", "Señor", "Monsieur", "Signor", "Господин", "Κύριος"]
FURTHER = ["Doctor", "Doktor", "Dr", "Professor", "Profesor", "Prof", "Ing", "Dipl", "Mag", "med", "phil", "Sir"]
PARTICLES = ["von", "van", "der", "den", "de", "la", "le", "del", "di", "da", "dos", "zu", "ten"]
SECRET_NAMES = ["password", "passwd", "token", "secret", "api_key"]

_TITLE = f"(?:{'|'.join(FEMALE + MALE)})"
#: A title, further ones, and initials: what stands before a name and stays.
_BEFORE = rf"{_TITLE}\.?(?: (?:{'|'.join(FURTHER)})\.?(?![\p{{L}}]))*(?: \p{{Lu}}\.)*"
_NAME = r"\p{Lu}[\p{L}\p{M}'’-]*[\p{L}\p{M}]"
_MORE = rf"(?: (?:{'|'.join(PARTICLES)}))* {_NAME}"
_FIRST = rf"(?:(?:{'|'.join(PARTICLES)}) )*{_NAME}"
#: Patterns by kind, in order of precedence where two start at the same place.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._+-])[A-Za-z0-9_+-][A-Za-z0-9._+-]{0,63}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "secret": rf"(?<![A-Za-z0-9_])(?:{'|'.join(SECRET_NAMES)})[ ]{{0,2}}[=:][ ]{{0,2}}[\"']?[0-9A-Za-z_+/-]{{8,}}",
    "hex": r"(?<![0-9A-Za-z])(?=[0-9a-fA-F]{32})(?=[a-fA-F]*[0-9])[0-9a-fA-F]{32,}+(?![0-9A-Za-z])",
    "key": r"(?<![0-9A-Za-z])(?:AKIA|ASIA)[0-9A-Z]{16}(?![0-9A-Za-z])",
    "ip": r"(?<![0-9A-Za-z.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?![0-9A-Za-z]|\.[0-9])",
    "phone": r"(?<![0-9A-Za-z+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9A-Za-z])",
    "national": r"(?<![0-9A-Za-z.+(-])(?:\([0-9]{3,5}\)[ ]?[0-9]{3,4}[ -]?[0-9]{3,5}|[0-9]{3}-[0-9]{3}-[0-9]{4}|0[0-9]{2,4}[ /-][0-9]{5,9})(?![0-9A-Za-z]|[.-][0-9])",
    "card": r"(?<![0-9A-Za-z])[3-6](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
    "name": rf"(?<![\p{{L}}0-9]){_BEFORE} {_FIRST}(?:{_MORE}){{0,2}}(?![\p{{L}}\p{{M}}])",
}
MENTION = "|".join(PATTERNS.values())
#: A text without any of these has no mention.
SIGNS = ["@", "+", "AKIA", "ASIA", *SECRET_NAMES, *FEMALE, *MALE]
NUMBER = r"[0-9][0-9. -]|[0-9a-fA-F]{32}"
#: Words of a text as names are written, and what stands between them. Shorter names are
#: not looked for without their title.
WORDS = r"\p{L}[\p{L}\p{M}]*(?:['’]\p{Lu}[\p{L}\p{M}]*|-\p{L}[\p{L}\p{M}]*)*|[^\p{L}]+"
LEAST_LETTERS = 3

# The letters of each class, canonical ones first; a letter becomes one of
# the canonical letters of its class.
CLASSES = [
    ("0123456789", "0123456789"),
    ("aeiou", "aeiouáéíóúàèìòùâêîôûäëïöüãõåæœāăąēĕėęěīĭįıōŏőøūŭůűų"),
    ("bcdfghjklmnprstvwz", "bcdfghjklmnprstvwzqxyßñçýž"),
    ("аеиоу", "аеиоуыэюяё"),
    ("бвгдзклмнпрст", "бвгдзклмнпрстжфхцчшщйьъ"),
    ("αειου", "αειουηωάέήίόύώ"),
    ("βγδκλμνπρστ", "βγδκλμνπρστζθξφχψς"),
]
#: Other letters become letters of their script, those of a script that isn't listed Latin
#: ones: no letter stays.
SCRIPTS = [
    (r"\p{IsCyrillic}", CLASSES[4][0]),
    (r"\p{IsGreek}", CLASSES[6][0]),
    (r"\p{IsArmenian}", "".join(map(chr, range(0x561, 0x587)))),
    (r"\p{IsGeorgian}", "".join(map(chr, range(0x10D0, 0x10F1)))),
    (r"\p{L}", CLASSES[2][0]),
]
# Typical endings of given names: of a script's vowels for women, consonants for men.
ENDINGS = {"given_f": "аαa", "given_m": "нνn"}

#: Attempts before the space of a type's surrogates counts as used up.
ATTEMPTS = 60
#: Used where the caller gives no key; real data need a secret one.
DEFAULT_KEY = b"example key, replace it"


@dataclass(frozen=True)
class Keyed:
    """HMAC-SHA256 of texts under a key, as built-in functions."""

    key: bytes

    def hex(self, message: Column) -> Column:
        key = hashlib.sha256(self.key).digest() if len(self.key) > 64 else self.key
        key = key.ljust(64, b"\0")
        inner, outer = (F.lit(bytes(b ^ pad for b in key)) for pad in (0x36, 0x5C))
        digest = F.unhex(F.sha2(F.concat(inner, message.cast("binary")), 256))
        return F.sha2(F.concat(outer, digest), 256)

    def stream(self, message: Column, letters: Column) -> Column:
        """At least ``letters`` numbers from 0 to 65535 that follow from the message."""
        blocks = F.sequence(F.lit(0), F.floor(letters / 16).cast("int"))
        hexes = F.array_join(
            F.transform(blocks, lambda i: self.hex(F.concat(message, F.lit("\n"), i))), ""
        )
        return let(
            hexes,
            lambda h: F.transform(
                F.sequence(F.lit(0), letters.cast("int")),
                lambda i: F.conv(F.substr(h, 4 * i + 1, F.lit(4)), 16, 10).cast("int"),
            ),
        )


def _letters(text: Column) -> Column:
    return F.split(text, "")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """The Luhn sum of a string of digits, of which the last is the check digit."""
    values = F.transform(F.reverse(_letters(digits)), lambda c: c.cast("int"))
    doubled = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    parts = F.transform(values, lambda d, i: F.when(i % 2 == 1, doubled(d)).otherwise(d))
    return F.aggregate(parts, F.lit(0), lambda a, d: a + d)


def _substituted(letter: Column, number: Column) -> Column:
    """Another letter of the same class, else of the same script, chosen by ``number``; what
    is no letter or digit stays."""
    low = F.lower(letter)
    out = letter
    fits = [(F.instr(F.lit(members), low) > 0, canonical) for canonical, members in CLASSES]
    fits += [(letter.rlike(script), canonical) for script, canonical in SCRIPTS]
    for fit, canonical in reversed(fits):
        own, place = F.instr(F.lit(canonical), low), number % (len(canonical) - 1) + 1
        place = F.when((own > 0) & (place >= own), place + 1).otherwise(place)
        chosen = F.substr(F.lit(canonical), place, F.lit(1))
        chosen = F.when(letter == low, chosen).otherwise(F.upper(chosen))
        out = F.when(fit, chosen).otherwise(out)
    return out


def surrogate(kind: Column, canonical: Column, attempt: Column, key: Keyed) -> Column:
    """The surrogate of an entity's canonical form at an attempt."""
    message = F.concat_ws("\n", kind, canonical, attempt.cast("string"))
    numbers = key.stream(message, F.char_length(canonical))

    def made(n: Column) -> Column:
        by_letter = lambda change: F.array_join(F.transform(_letters(canonical), change), "")
        plain = by_letter(lambda c, i: _substituted(c, F.get(n, i)))
        hexed = by_letter(
            lambda c, i: F.when(
                c.rlike("[0-9a-f]"), F.lower(F.hex((F.get(n, i) % 16).cast("long")))
            ).when(c.rlike("[A-F]"), F.hex((10 + F.get(n, i) % 6).cast("long"))).otherwise(_substituted(c, F.get(n, i)))
        )
        # The top-level domain stays, as it tells the kind of address.
        top = F.regexp_extract(canonical, r"\.[a-z]+$", 0)
        email = F.concat(F.substr(plain, F.lit(1), F.char_length(canonical) - F.char_length(top)), top)
        octets = F.array_join(
            F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (1 + F.get(n, i) % 254).cast("string")), "."
        )
        # The first digit stays: it tells the card's scheme, or begins the country.
        leading = F.concat(F.substr(canonical, F.lit(1), F.lit(1)), F.substr(plain, F.lit(2)))
        card = let(
            F.substr(leading, F.lit(1), F.char_length(canonical) - 1),
            lambda p: F.concat(p, ((10 - _luhn(F.concat(p, F.lit("0"))) % 10) % 10).cast("string")),
        )
        card = F.when(_luhn(canonical) % 10 == 0, card).otherwise(leading)
        last = F.substr(canonical, F.char_length(canonical), F.lit(1))
        script = F.when(last.rlike(r"\p{IsCyrillic}"), 1).when(last.rlike(r"\p{IsGreek}"), 2)
        script = script.when(last.rlike(r"\p{IsLatin}"), 3)
        ending = F.when(kind == "given_f", F.substr(F.lit(ENDINGS["given_f"]), script, F.lit(1)))
        ending = ending.otherwise(F.substr(F.lit(ENDINGS["given_m"]), script, F.lit(1)))
        ending = F.coalesce(ending, F.substr(plain, F.char_length(plain), F.lit(1)))
        given = F.concat(F.substr(plain, F.lit(1), F.char_length(plain) - 1), ending)
        # Names and some addresses are short, so later attempts add letters or digits: no
        # space of surrogates is used up.
        times = F.floor(attempt / 4).cast("int")
        tail = F.repeat(F.substr(plain, F.lit(1), F.lit(2)), times)
        return (
            F.when(kind == "email", F.concat(F.repeat(F.substr(plain, F.lit(1), F.lit(1)), times), email))
            .when(kind == "secret", hexed)
            .when(kind == "ip", octets)
            .when(kind == "phone", F.concat(leading, F.translate(tail, "+", "")))
            .when(kind == "card", card)
            .when(kind.startswith("given"), F.concat(tail, given))
            .otherwise(F.concat(plain, tail))
        )

    return let(numbers, made)


def _maybe(text: Column) -> Column:
    """Whether a text has what every mention has; costs little where it has not."""
    out = text.rlike(NUMBER)
    for sign in SIGNS:
        out = out | text.contains(sign)
    return out


def mentions(text: Column) -> Column:
    """The mentions of a text, in order, as they are written."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(MENTION), F.lit(0))


def _parts(raw: Column) -> Column:
    """Array of (kind, before, part): the entities in a mention, each with what stands
    before it and stays."""
    part = lambda kind, before, text: F.struct(
        kind.alias("kind"), before.alias("before"), text.alias("part")
    )
    one = lambda kind: F.array(part(F.lit(kind), F.lit(""), raw))
    whole = lambda kind: raw.rlike(f"^(?:{PATTERNS[kind]})$")
    prefix = F.regexp_extract(raw, r"^[a-z_]+[ ]*[=:][ ]*[\"']?", 0)
    secret = F.array(part(F.lit("secret"), prefix, F.substr(raw, F.char_length(prefix) + 1)))
    # What begins the key tells its kind and stays.
    key = F.array(part(F.lit("key"), F.substr(raw, F.lit(1), F.lit(4)), F.substr(raw, F.lit(5))))
    # The names after titles: the first of several is given, others are family names.
    title = F.regexp_extract(raw, rf"^{_BEFORE} ", 0)
    female = F.regexp_extract(raw, rf"^(?:{'|'.join(FEMALE)})(?![\p{{L}}])", 0) != ""
    given = F.when(female, "given_f").otherwise("given_m")
    names = F.regexp_extract_all(
        F.substr(raw, F.char_length(title) + 1), F.lit(rf"(?:^{_FIRST}|{_MORE})(?![\p{{L}}\p{{M}}])"), F.lit(0)
    )

    def named(words: Column, i: Column) -> Column:
        name = F.regexp_extract(words, rf"{_NAME}$", 0)
        before = F.substr(words, F.lit(1), F.char_length(words) - F.char_length(name))
        kind = F.when((i == 0) & (F.size(names) > 1), given).otherwise("family")
        return part(kind, F.when(i == 0, F.concat(title, before)).otherwise(before), name)

    return (
        F.when(whole("email"), one("email"))
        .when(whole("secret"), secret)
        .when(whole("hex"), one("secret"))
        .when(whole("key"), key)
        .when(whole("ip"), one("ip"))
        .when(whole("phone") | whole("national"), one("phone"))
        .when(whole("card"), one("card"))
        .otherwise(F.transform(names, named))
    )


def _unmarked(part: Column) -> Column:
    """Without combining marks, which are letters' accents."""
    return F.regexp_replace(part, r"\p{M}+", "")


def _canonical(kind: Column, part: Column) -> Column:
    # Secrets are told apart by capitals, all else is not.
    plain = F.when(kind == "secret", part).otherwise(F.lower(_unmarked(part)))
    return F.when(kind.isin("phone", "card"), _digits(part)).otherwise(plain)


def _written(kind: Column, part: Column, surrogate: Column) -> Column:
    """A surrogate in the form of a mention's part."""
    part = _unmarked(part)
    letters = _letters(part)
    before = lambda i: F.char_length(_digits(F.substr(part, F.lit(1), i)))
    digit = lambda c, i: F.when(c.rlike("[0-9]"), F.substr(surrogate, before(i) + 1, F.lit(1))).otherwise(c)
    numbers = F.array_join(F.transform(letters, digit), "")
    numbers = F.concat(numbers, F.substr(surrogate, F.char_length(_digits(part)) + 1))
    raised = F.array_join(
        F.transform(
            _letters(surrogate),
            lambda s, i: F.when(F.coalesce(F.get(letters, i), F.lit("")).rlike(r"\p{Lu}"), F.upper(s)).otherwise(s),
        ),
        "",
    )
    return (
        F.when(kind.isin("phone", "card"), numbers)
        .when((F.char_length(part) > 1) & (part == F.upper(part)) & (part != F.lower(part)), F.upper(surrogate))
        .when(kind == "ip", surrogate)
        .otherwise(raised)
    )


def surrogates(entities: DataFrame, key: Keyed, stages: Stages) -> DataFrame:
    """(kind, canonical, surrogate) for distinct entities (kind, canonical).

    An attempt settles every entity whose candidate no other one wants, that no settled one
    has and that is no real entity; of those that want the same the smallest gets it.
    Fails if a kind has more entities than ATTEMPTS attempts can place.
    """
    entities = stages.write(entities.distinct(), "entities")
    real = entities.select("kind", F.col("canonical").alias("surrogate"))
    open_, settled = entities, []
    for attempt in range(ATTEMPTS):
        tried = stages.write(
            open_.withColumn(
                "surrogate", surrogate(F.col("kind"), F.col("canonical"), F.lit(attempt), key)
            ),
            f"tried-{attempt}",
        )
        wanted = tried.groupBy("kind", "surrogate").agg(F.min("canonical").alias("canonical"))
        free = wanted.join(real, ["kind", "surrogate"], "left_anti")
        for earlier in settled:
            free = free.join(earlier, ["kind", "surrogate"], "left_anti")
        settled.append(stages.write(free.select("kind", "canonical", "surrogate"), f"settled-{attempt}"))
        open_ = tried.select("kind", "canonical").join(
            settled[-1], ["kind", "canonical"], "left_anti"
        )
        open_ = stages.write(open_, f"open-{attempt}")
        if open_.isEmpty():
            out = settled[0]
            for more in settled[1:]:
                out = out.unionByName(more)
            return out
    raise ValueError("a kind of entity has more members than surrogates")


def pseudonymized(
    docs: DataFrame, text: str = "text", key: bytes = DEFAULT_KEY
) -> DataFrame:
    """``docs`` with entities in ``text`` replaced, and the column ``n_mentions``.

    A null text stays null; a text without a mention is returned as it is. Repeated rows
    and repeated ids get the same replacements, since these depend on the text alone. A
    name of LEAST_LETTERS letters or more that a text has after a title is replaced in that
    text where it stands alone, too; such places don't count as mentions. A column named
    n_mentions is replaced; others pass through.
    """
    stages, keyed = Stages(docs.sparkSession, "pii"), Keyed(key)
    row, whole_text = carried(docs, ["n_mentions"]), F.coalesce(docs[text], F.lit(""))
    has = _maybe(whole_text) & whole_text.rlike(MENTION)
    clean = docs.filter(~has).select(row.alias("row"))
    clean = clean.select("row.*", F.lit(0).cast("long").alias("n_mentions"))
    found = docs.filter(has).select(
        row.alias("row"), docs[text].alias("text"), F.md5(docs[text]).alias("_digest"), mentions(docs[text]).alias("mentions")
    )
    found = stages.write(found, "found")

    held = stages.write(
        found.select("_digest", F.posexplode("mentions").alias("_place", "_raw")).distinct(), "mentions"
    )
    raws = stages.write(
        held.select("_raw").distinct().select(
            "_raw", F.posexplode(_parts(F.col("_raw"))).alias("_no", "_part")
        ).select("_raw", "_no", "_part.*", _canonical(F.col("_part.kind"), F.col("_part.part")).alias("canonical")),
        "parts",
    )
    made = surrogates(raws.select("kind", "canonical"), keyed, stages)
    written = raws.join(made, ["kind", "canonical"]).select(
        "_raw", "_no", "kind", "before", "part",
        _written(F.col("kind"), F.col("part"), F.col("surrogate")).alias("_new"),
    )
    written = stages.write(written, "written")
    # A mention has three parts at most; a text's mentions are as many as it holds.
    joined = F.array_sort(F.collect_list(F.struct("_no", F.concat("before", "_new").alias("_new"))))
    whole = written.groupBy("_raw").agg(joined.alias("_n"))
    whole = whole.select("_raw", F.array_join("_n._new", "").alias("_new"))
    replaced = held.join(whole, "_raw").groupBy("_digest").agg(
        F.array_sort(F.collect_list(F.struct("_place", "_new"))).alias("_news")
    )
    named = written.filter(F.col("kind").startswith("given") | (F.col("kind") == "family"))
    named = named.filter(F.char_length("part") >= LEAST_LETTERS).select("_raw", "part", "_new")
    named = held.select("_digest", "_raw").distinct().join(named, "_raw")
    # A word that is given name and family name has one replacement in a text.
    named = named.groupBy("_digest", "part").agg(F.min("_new").alias("_new"))
    named = named.groupBy("_digest").agg(F.map_from_entries(F.collect_list(F.struct("part", "_new"))).alias("_names"))
    replaced = replaced.join(named, "_digest", "left").select("_digest", F.col("_news._new").alias("_news"), "_names")

    changed = found.join(replaced, "_digest")
    known = lambda w: F.coalesce(F.try_element_at(F.col("_names"), w), w)
    again = lambda part: F.array_join(
        F.transform(
            F.regexp_extract_all(part, F.lit(WORDS), F.lit(0)),
            lambda w: F.when(w.rlike(r"^\p{Lu}"), known(w)).otherwise(w),
        ),
        "",
    )
    between = F.split(F.col("text"), MENTION, -1)
    between = F.when(F.col("_names").isNull(), between).otherwise(F.transform(between, again))
    whole = F.array_join(
        F.zip_with(between, F.concat("_news", F.array(F.lit(""))), lambda a, b: F.concat(a, b)), ""
    )
    changed = changed.select(
        F.col("row").withField(text, whole).alias("row"), F.size("mentions").cast("long").alias("n_mentions")
    )
    return clean.unionByName(changed.select("row.*", "n_mentions"))
