"""Personal data replaced by keyed surrogates.

Entities (e-mail and IP addresses, phone, card, account and social security numbers, keys and
other secrets, names after an honorific) are found by patterns.  Every distinct entity of the
corpus gets one surrogate of its type, drawn from a keyed hash of the entity:

* format: digits stay digits, letters keep case and script, punctuation and length stay; an
  octet stays in the range of its digits, a valid card number stays valid, a top-level domain
  and a phone's first digit stay;
* gender: names are spelt from syllables with an ending that fits the honorific, in its script;
* coreference: writings of one entity (spaces and dashes in a number, case of an address) share
  their surrogate, wherever they stand;
* distinctness: a surrogate that two entities of a type share, or that is itself an entity of
  the corpus, is drawn again for all but the first, until none is left.

All of it is DataFrame expressions.  Only documents that hold an entity are shuffled; entities
are made distinct by an aggregate before they are joined, and the join back to a document's
entities can be split by adaptive execution.

Defined results: a null text stays null, a text without entities is returned as it is; the
noncharacters U+FDD0 and U+FDD1 are dropped from texts that hold entities; repeated rows are
treated alike; an empty table gives an empty result; further columns are passed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import let, stored

KEY = "eventide"
OPEN, CLOSE = "\ufdd0", "\ufdd1"
# honorifics by gender: fixed values, in natural order
MALE = r"Mr|Herr|Monsieur|Señor|Sr|Don|Signor|господин|г-н|κύριος"
FEMALE = r"Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Doña|Signora|госпожа|г-жа|κυρία"
NEUTRAL = r"Dr|Prof"
PATTERNS = {
    "secret": r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key)\s{0,2}[=:]\s{0,2}[\"']?)[^\s\"',;]{6,}",
    # tried once a run of its characters, never taken back, labels and their number bounded as in the DNS: a
    # longer run before the @ (mail allows 64) or a longer label is no address
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,256}+@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+){0,126}\.[A-Za-z]{2,63}",
    "key": r"\bAKIA[0-9A-Z]{16}\b",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?<![\w+])(?:\+?\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)"
             r"|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)|(?<![\w.-])\d{3}[ .-]\d{3}[ .-]\d{4}(?![\w-])",
    "card": r"(?<![\w.-])\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\w-])",
    "name": rf"(?<!\w)(?:{MALE}|{FEMALE}|{NEUTRAL})\.? \p{{Lu}}[\p{{L}}'-]+(?: \p{{Lu}}[\p{{L}}'-]+){{0,2}}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
HINT = rf"[0-9@]|(?i:password|passwd|pwd|secret|token|api[_-]?key)|(?<!\w)(?:{MALE}|{FEMALE}|{NEUTRAL})\.? \p{{Lu}}"
LATIN, CYRILLIC, GREEK = "abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщъыьэюя", "αβγδεζηθικλμνξοπρστυφχψω"
# consonants and vowels of name syllables, and endings (male, female, neutral), by script
SYLLABLES = {"latin": ("bdfghklmnprstv", "aeiou", ("n", "a", "is")),
             "cyrillic": ("бвгдзклмнпрст", "аеиоу", ("н", "на", "ль")),
             "greek": ("βγδζκλμνπρστφ", "αεηιο", ("ς", "α", "ις"))}


def split_entities(text: Column) -> Column:
    """Text cut so that every second part (from the second) is an entity."""
    clean = F.regexp_replace(text, f"[{OPEN}{CLOSE}]", "")
    return F.split(F.regexp_replace(clean, f"({ANY})", f"{OPEN}$1{CLOSE}"), f"[{OPEN}{CLOSE}]")


def kind(entity: Column) -> Column:
    out = F.lit("name")
    for name, pattern in reversed(list(PATTERNS.items())):
        out = F.when(F.regexp_like(entity, F.lit(f"^(?:{pattern})$")), F.lit(name)).otherwise(out)
    return out


def value(entity: Column, kind_: Column) -> Column:
    """The part that is replaced: without the label of a secret or the honorific of a name."""
    return (F.when(kind_ == "secret", F.regexp_replace(entity, r"^[^=:]+[=:]\s{0,2}[\"']?", ""))
            .when(kind_ == "name", F.regexp_replace(entity, r"^\S+ ", "")).otherwise(entity))


def canonical(entity: Column, kind_: Column) -> Column:
    """What all writings of an entity share."""
    v = value(entity, kind_)
    gender = (F.when(F.regexp_like(entity, F.lit(rf"^(?:{MALE})\b")), "m")
              .when(F.regexp_like(entity, F.lit(rf"^(?:{FEMALE})\b")), "f").otherwise("n"))
    return (F.when(kind_ == "email", F.lower(v)).when(kind_.isin("secret", "key", "ip"), v)
            .when(kind_ == "name", F.concat(gender, F.lit("|"), F.lower(v)))
            .otherwise(F.regexp_replace(v, r"[^\p{L}\p{N}]", "")))


def _stream(seed: Column, n: Column) -> Column:
    """Blocks of a keyed hash, enough for ``n`` draws of 16 bits."""
    return F.transform(F.sequence(F.lit(0), F.floor(n / 15).cast("int")),
                       lambda j: F.sha2(F.concat_ws("#", seed, j.cast("string")), 256))


def _byte(stream: Column, i: Column) -> Column:
    """Draw ``i``: 16 bits, so that remainders are nearly even (15 draws a block, found at once)."""
    i = i if isinstance(i, Column) else F.lit(i)
    block = F.get(stream, F.floor(i / 15).cast("int"))
    return F.conv(F.substr(block, (i % 15) * 4 + 1, F.lit(4)), 16, 10).cast("int")


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _letter(alphabet: str, b: Column) -> Column:
    return F.substr(F.lit(alphabet), b % len(alphabet) + 1, F.lit(1))


def _swap(c: Column, b: Column, hexed: Column) -> Column:
    """Another character of the same class."""
    low = F.lower(c)
    new = (F.when(hexed & low.rlike("[0-9a-f]"), _letter("0123456789abcdef", b))
           .when(c.rlike("[0-9]"), _letter("0123456789", b))
           .when(low.rlike("[а-я]"), _letter(CYRILLIC, b)).when(low.rlike("[α-ω]"), _letter(GREEK, b))
           .when(c.rlike(r"\p{L}"), _letter(LATIN, b)).otherwise(c))
    return F.when(c == low, new).otherwise(F.upper(new))


def surrogate(kind_: Column, canon: Column, attempt: Column, key: str = KEY) -> Column:
    """The surrogate of a canonical entity, character for character (names: spelt anew)."""
    seed = F.concat_ws("|", F.lit(key), kind_, canon, attempt.cast("string"))
    chars = F.split(canon, "")
    n = F.length(canon)
    hexed = F.regexp_like(canon, F.lit("^[0-9a-f]+$")) & (kind_ == "secret")
    # what stays: the top-level domain, the first digit of phones and cards, the mark of a key
    tail = F.when(kind_ == "email", F.length(F.regexp_extract(canon, r"\.[^.]*$", 0))).otherwise(0)
    head = F.when(kind_.isin("phone", "card"), 1).when(kind_ == "key", 4).otherwise(0)

    def spelt(s):
        # what does not depend on the character is found once
        whole = F.struct(head.alias("head"), (n - tail).alias("end"), hexed.alias("hexed"))
        drawn = let(whole, lambda w: F.transform(chars, lambda c, i: F.when((i < w["head"]) | (i >= w["end"]), c)
                                                 .otherwise(_swap(c, _byte(s, i), w["hexed"]))))
        text = F.array_join(drawn, "")
        valid = (kind_ == "card") & _luhn(canon)
        body = F.substr(text, F.lit(1), n - 1)
        check = F.filter(F.sequence(F.lit(0), F.lit(9)), lambda d: _luhn(F.concat(body, d.cast("string"))))
        octet = lambda o, i: (F.when((attempt >= 16) | (F.length(o) == 3), 100 + _byte(s, i) % 155)
                              .when(F.length(o) == 2, 10 + _byte(s, i) % 90).otherwise(1 + _byte(s, i) % 9))
        octets = F.array_join(F.transform(F.split(canon, r"\."), lambda o, i: octet(o, i).cast("string")), ".")
        return (F.when(kind_ == "ip", octets).when(valid, F.concat(body, F.get(check, F.lit(0)).cast("string")))
                .otherwise(text))

    def named(s):
        plain, gender = F.substr(canon, F.lit(3)), F.substr(canon, F.lit(1), F.lit(1))

        def one(script):
            first, second, ends = SYLLABLES[script]
            end = F.when(gender == "m", ends[0]).when(gender == "f", ends[1]).otherwise(ends[2])
            part = lambda k: F.concat(_letter(first, _byte(s, k)), _letter(second, _byte(s, k + 1)))
            word = lambda i: F.initcap(F.concat(part(i * 8), part(i * 8 + 2), part(i * 8 + 4), end))
            return F.array_join(F.transform(F.split(plain, " "), lambda w, i: word(i)), " ")
        return (F.when(plain.rlike("[а-я]"), one("cyrillic")).when(plain.rlike("[α-ω]"), one("greek"))
                .otherwise(one("latin")))

    return F.when(kind_ == "name", let(_stream(seed, F.lit(64)), named)).otherwise(
        let(_stream(seed, n + 2), spelt))


def written(entity: Column, kind_: Column, new: Column) -> Column:
    """The surrogate in the writing of one occurrence."""
    v = value(entity, kind_)
    lead = F.substr(entity, F.lit(1), F.length(entity) - F.length(v))
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("k"))

    def fill(acc, c):
        own = c.rlike(r"[\p{L}\p{N}]")
        x = F.substr(new, acc["k"] + 1, F.lit(1))
        return F.struct(F.concat(acc["text"], F.when(own, x).otherwise(c)).alias("text"),
                        (acc["k"] + own.cast("int")).alias("k"))
    spaced = F.aggregate(F.split(v, ""), start, fill, lambda acc: acc["text"])
    cased = F.array_join(F.transform(F.split(v, ""), lambda c, i: let(
        F.substr(new, i + 1, F.lit(1)), lambda x: F.when(c == F.lower(c), x).otherwise(F.upper(x)))), "")
    body = (F.when(kind_.isin("ip", "secret", "key", "name"), new).when(kind_ == "email", cased).otherwise(spaced))
    return F.concat(lead, body)


def assign(entities: DataFrame, key: str = KEY, rounds: int = 64) -> DataFrame:
    """(kind, canon, surrogate) for the distinct (kind, canon), without collisions."""
    plain = F.when(F.col("kind") == "name", F.lower(F.substr("canon", F.lit(3)))).otherwise(F.col("canon"))
    now = entities.select("kind", "canon").distinct().withColumn("attempt", F.lit(0))
    real = entities.select(F.col("kind").alias("rk"), plain.alias("real")).distinct()
    for _ in range(rounds):
        now = now.select("kind", "canon", "attempt").withColumn(
            "surrogate", surrogate(F.col("kind"), F.col("canon"), F.col("attempt"), key))
        now = stored(now.join(real, (F.col("kind") == F.col("rk")) & (F.lower("surrogate") == F.lower("real")), "left")
                     .withColumn("taken", F.col("real").isNotNull()).drop("rk", "real").distinct(), "surrogates")
        first = now.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "canon")).alias("first"))
        first = first.select(F.col("kind").alias("fk"), F.col("surrogate").alias("fs"), "first")
        now = now.join(first, (F.col("kind") == F.col("fk")) & (F.col("surrogate") == F.col("fs")))
        again = F.col("taken") | (F.struct("attempt", "canon") != F.col("first"))
        now = stored(now.withColumn("again", again).select("kind", "canon", "attempt", "surrogate", "again"), "surrogates")
        if now.where("again").limit(1).count() == 0:
            return now.select("kind", "canon", "surrogate")
        now = now.withColumn("attempt", F.col("attempt") + F.col("again").cast("int"))
    raise RuntimeError(f"surrogates still collide after {rounds} rounds")


def pseudonymise(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with entities replaced, and n_replaced."""
    docs = docs.select(*[c for c in docs.columns if c != "n_replaced"])
    hinted = F.coalesce(F.regexp_like("text", F.lit(HINT)), F.lit(False))
    held = F.coalesce(hinted & F.regexp_like("text", F.lit(ANY)), F.lit(False))
    without = docs.where(~held).withColumn("n_replaced", F.lit(0))
    found = docs.where(held).select(F.struct("*").alias("row"), split_entities(F.col("text")).alias("parts"))
    found = stored(found.withColumn("key", F.monotonically_increasing_id()), "entities")
    every = F.transform(F.sequence(F.lit(1), F.greatest(F.size("parts") - 1, F.lit(1)), F.lit(2)),
                        lambda i: F.get("parts", i))
    seen = found.select("key", F.explode(F.array_distinct(every)).alias("entity")).where("entity IS NOT NULL")
    seen = seen.withColumn("kind", kind(F.col("entity"))).withColumn("canon", canonical(F.col("entity"), F.col("kind")))
    table = assign(seen, key)
    seen = seen.join(table.select(F.col("kind").alias("k"), F.col("canon").alias("c"), "surrogate"),
                     (F.col("kind") == F.col("k")) & (F.col("canon") == F.col("c")))
    seen = seen.withColumn("new", written(F.col("entity"), F.col("kind"), F.col("surrogate")))
    maps = seen.groupBy(F.col("key").alias("k")).agg(
        F.map_from_entries(F.collect_list(F.struct("entity", "new"))).alias("m"))
    found = found.join(maps, F.col("key") == F.col("k"), "left")
    text = F.array_join(F.transform("parts", lambda p, i: F.when(i % 2 == 1, F.coalesce(F.element_at("m", p), p))
                                    .otherwise(p)), "")
    changed = found.select(*[text.alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns],
                           F.floor(F.size("parts") / 2).cast("int").alias("n_replaced"))
    return without.unionByName(changed)
