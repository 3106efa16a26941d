"""PII replacement by surrogates.

One pattern finds e-mail addresses, phone, card and social security numbers,
IBANs, IP addresses, access keys, passwords, long hex secrets and persons named
after a title. Every distinct entity gets a surrogate drawn from
SHA-512(key, kind, entity, attempt):

* type and format: digits become digits, letters letters of the same script and
  case, separators stay; country codes, a card's first digit and (if it was
  valid) its check digit, access key prefixes and top-level domains keep their
  meaning; IP addresses come from 10.0.0.0/8;
* gender and script: persons get a given name of the title's gender and a
  surname built from syllables of the name's script;
* coreference: one entity has one surrogate everywhere, in the format of each
  mention ("+1 (650) 555-0100" and "+1 650 555 0100" agree);
* distinctness: surrogates of a kind are compared with each other and with all
  entities; of equal ones all but the first are drawn again until none is left.
  After ``ATTEMPTS`` draws surrogates get longer by letters or digits, two more
  with every draw, so there are enough of them for any number of entities (IP
  addresses keep their form and come from 240.0.0.0/4 then). Symbols of a
  password without digits and letters become letters.

Equal texts are replaced once. All steps are built-in functions.

Row rules: null text stays null, empty text empty; both have no entities.
Repeated rows, long texts, other columns and empty tables are plain cases.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_side, stored, text_or_empty

BROADCAST_ROWS = 250_000
ATTEMPTS = 8                  # draws in the entity's own length

# Titles by gender, given names by gender and script, syllables.
TITLES = {"m": ["Mr", "Herr", "Señor", "Monsieur", "Sr", "г-н", "Господин"],
          "f": ["Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "Mme", "Sra", "г-жа", "Госпожа"]}
GIVEN = {("m", "latin"): ["Adrian", "Bruno", "Conrad", "Dennis", "Edgar", "Fabian", "Gustav", "Hugo", "Ivan", "Jonas", "Karl", "Leon"],
         ("f", "latin"): ["Alma", "Bianca", "Clara", "Diana", "Elsa", "Flora", "Greta", "Helena", "Irma", "Julia", "Karin", "Lea"],
         ("m", "cyrillic"): ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор"],
         ("f", "cyrillic"): ["Анна", "Вера", "Галина", "Дарья", "Елена", "Зоя"]}
SYLLABLES = {"latin": ["ba", "den", "fel", "gor", "hal", "kin", "lo", "mar", "nes", "pol", "ri", "sen", "tor", "vel", "wal", "zin"],
             "cyrillic": ["ба", "дин", "фе", "гор", "ка", "лов", "мар", "нес", "пол", "ри", "сен", "тор", "вел", "во", "зин", "ков"]}
LETTERS = {"[a-z]": "abcdefghijklmnopqrstuvwxyz", r"\p{IsCyrillic}": "абвгдежзиклмнопрстуфхцчшэюя", r"\p{IsGreek}": "αβγδεζηθικλμνξοπρστυφχψω",
           r"\p{L}": "abcdefghijklmnopqrstuvwxyz"}

NAME = r"\p{Lu}[\p{L}'’-]+(?: \p{Lu}[\p{L}'’-]+){0,2}"
#: kind: (pattern of a whole mention, pattern of the part in front that stays)
KINDS = {
    "email": (r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+", ""),
    "password": (r"(?i:\b(?:password|passwd|pwd)\s?[=:]\s?[\"']?)[\p{L}\p{N}_$%&#@!*+-]{4,}", r"(?i)^(?:password|passwd|pwd)\s?[=:]\s?[\"']?"),
    "key": (r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b", "^(?:AKIA|ASIA)"),
    "hex": (r"\b(?:[0-9a-f]{32,}|[0-9A-F]{32,})\b", ""),
    "iban": (r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b", "^[A-Z]{2}"),
    "ip": (r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)", ""),
    "ssn": (r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", ""),
    "card": (r"(?<![\d+])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?!\d)", ""),
    "phone": (r"(?<![\p{L}\d])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)|\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\d)", r"^\+\d{1,3}(?=[ .(-])"),
    "person": (rf"\b(?:{'|'.join(t for v in TITLES.values() for t in v)})\.? {NAME}", rf"^(?:{'|'.join(t for v in TITLES.values() for t in v)})\.? "),
}
PATTERN = "|".join(f"(?:{p})" for p, _ in KINDS.values())
DIGITS = ("ssn", "card", "phone")


def kind_of(mention: Column) -> Column:
    out = F.lit(None).cast("string")
    for kind, (pattern, _) in reversed(KINDS.items()):
        out = F.when(mention.rlike(rf"^(?:{pattern})$"), kind).otherwise(out)
    return out


def parts(mentions: DataFrame) -> DataFrame:
    """mention, kind, fixed (part in front that stays), body, canon, extra
    (what the surrogate depends on besides: gender and script, or fixed)."""
    body, fixed = F.col("mention"), F.lit("")
    for kind, (_, front) in KINDS.items():
        if front:
            fixed = F.when(F.col("kind") == kind, F.regexp_extract("mention", f"({front})", 1)).otherwise(fixed)
    df = mentions.withColumn("kind", kind_of(F.col("mention"))).withColumn("fixed", fixed)
    df = df.withColumn("body", F.expr("substring(mention, char_length(fixed) + 1)"))
    title = F.regexp_replace("fixed", r"[. ]", "")
    gender = F.when(title.isin(TITLES["m"]), "m").otherwise("f")
    script = F.when(body.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")
    person = F.col("kind") == "person"
    return df.withColumn("canon", F.when(F.col("kind").isin(*DIGITS), F.concat("fixed", F.regexp_replace("body", r"\D", "")))
                         .when(F.col("kind") == "iban", F.regexp_replace("mention", " ", ""))
                         .when(F.col("kind").isin("email", "person"), F.lower("body")).otherwise(F.col("body"))).withColumn(
        "gender", F.when(person, gender)).withColumn("script", F.when(person, script))


def drawn(position: Column, modulus: int) -> Column:
    """The stream's value at a position: a column `h` holds 64 bytes in hex."""
    at = (position % 64) * 2
    return F.conv(F.col("h").substr(at + 1, F.lit(2)), 16, 10).cast("int") % modulus


def pick(choices: list[str] | str, position: Column) -> Column:
    return F.get(F.array(*map(F.lit, choices)), drawn(position, len(choices)))


def swapped(text: Column, hex_only: bool = False) -> Column:
    """Each digit and letter replaced by one of its class, lower or upper case kept."""
    def one(c: Column, i: Column) -> Column:
        small = F.lower(c)
        new = F.when(c.rlike("[0-9a-fA-F]"), pick("0123456789abcdef", i)) if hex_only else F.when(c.rlike("[0-9]"), pick("0123456789", i))
        for pattern, letters in LETTERS.items():
            new = new.when(small.rlike(pattern), pick(letters, i))
        new = new.otherwise(c)
        return F.when(c != small, F.upper(new)).otherwise(new)
    return F.array_join(F.transform(F.split(text, ""), one), "")


def luhn_sum(digits: Column) -> Column:
    n = F.char_length(digits)
    return F.aggregate(F.transform(F.split(digits, ""), lambda c, i: F.when(
        (n - 1 - i) % 2 == 1, (c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5)).otherwise(c.cast("int")).cast("int")),
        F.lit(0), lambda a, x: a + x)


def with_stream(entities: DataFrame, key: str) -> DataFrame:
    return entities.withColumn("h", F.sha2(F.concat_ws("|", F.lit(key), "kind", "canon", "gender", "script", "attempt"), 512))


def draw(entities: DataFrame, key: str) -> DataFrame:
    """``core``: the surrogate of each (kind, canon, gender, script, fixed) at its attempt."""
    df = with_stream(entities, key)
    n = F.char_length("canon")
    digits = swapped(F.col("canon"))
    card = F.concat(F.col("canon").substr(F.lit(1), F.lit(1)), digits.substr(F.lit(2), n - 2))
    df = df.withColumn("card", F.when(F.col("kind") == "card", card))
    check = (10 - luhn_sum(F.concat("card", F.lit("0"))) % 10) % 10
    person = None
    for (gender, script), names in GIVEN.items():
        surname = F.initcap(F.concat(*[pick(SYLLABLES[script], F.lit(k)) for k in range(2, 6)]))
        words = F.size(F.split("canon", " "))
        made = F.when(words == 1, surname).otherwise(F.array_join(F.concat(F.array_repeat(pick(names, F.lit(1)), words - 1), F.array(surname)), " "))
        at = (F.col("gender") == gender) & (F.col("script") == script)
        person = F.when(at, made) if person is None else person.when(at, made)
    tld = F.regexp_extract("canon", r"\.([^.@]*)$", 1)
    core = (F.when(F.col("kind") == "person", person)
            .when(F.col("kind") == "ip", F.concat_ws(".", F.lit("10"), drawn(F.lit(0), 256), drawn(F.lit(1), 256), drawn(F.lit(2), 256)))
            .when(F.col("kind") == "card", F.concat("card", F.when(luhn_sum(F.col("canon")) % 10 == 0, check.cast("string")).otherwise(digits.substr(n, F.lit(1)))))
            .when(F.col("kind") == "email", F.concat(swapped(F.expr("substring(canon, 1, char_length(canon) - char_length(regexp_extract(canon, '[.]([^.@]*)$', 1)))")), tld))
            .when(F.col("kind").isin("phone", "iban"), F.concat("fixed", swapped(F.expr("substring(canon, char_length(fixed) + 1)"))))
            .when(F.col("kind") == "hex", swapped(F.col("canon"), hex_only=True))
            .otherwise(digits))
    bare = (F.col("kind") == "password") & ~F.col("canon").rlike(r"[\p{L}0-9]")
    letters = F.array_join(F.transform(F.split("canon", ""), lambda c, i: pick(LETTERS["[a-z]"], i)), "")
    return df.withColumn("core", F.when(bare, letters).otherwise(core)).drop("h", "card")


def lengthened(entities: DataFrame, key: str, by: int) -> DataFrame:
    """``core`` made longer by that many characters."""
    more = lambda of: F.concat(*[pick(of, F.lit(k)) for k in range(3, 3 + by)])
    ip = F.concat_ws(".", drawn(F.lit(3), 16) + 240, *[drawn(F.lit(k), 256) for k in (4, 5, 6)])
    return with_stream(entities, key).withColumn("core", F.when(F.col("kind") == "ip", ip)
        .when(F.col("kind") == "email", F.concat(more(LETTERS["[a-z]"]), "core"))
        .when(F.col("kind").isin("password", "person"), F.concat("core", more(LETTERS["[a-z]"])))
        .otherwise(F.concat("core", more("0123456789")))).drop("h")


def assign(entities: DataFrame, key: str) -> DataFrame:
    """Distinct entities with distinct surrogates that are no entity either."""
    todo, done = entities.withColumn("attempt", F.lit(0)), None
    real = entities.select("kind", F.lower("canon").alias("low")).distinct()
    for attempt in count():
        now = draw(todo, key)
        if attempt >= ATTEMPTS:
            now = lengthened(stored(now, "short"), key, min(4 + 2 * (attempt - ATTEMPTS), 60))
        drawn_now = stored(now.withColumn("low", F.lower("core")), "drawn")
        ok = drawn_now.join(real, ["kind", "low"], "left_anti")
        if done is not None:
            ok = ok.join(done.select("kind", "low"), ["kind", "low"], "left_anti")
        name = F.struct("canon", F.coalesce("gender", F.lit("")), F.coalesce("script", F.lit("")))
        first = ok.groupBy("kind", "low").agg(F.min(name).alias("first"))
        taken = stored(ok.join(first, ["kind", "low"]).where(name == F.col("first")).drop("first"), "surrogates")
        done = taken if done is None else done.unionByName(taken)
        same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("kind", "canon", "gender", "script")]
        todo = stored(drawn_now.alias("a").join(taken.alias("b"), same, "left_anti").drop("core", "low"), "again").withColumn(
            "attempt", F.lit(attempt + 1))
        if todo.isEmpty():
            return done.drop("low", "attempt")


def rendered(mention: str, fixed: str, body: str, core: str) -> Column:
    """The surrogate in the mention's format and case."""
    tail = lambda a: F.concat(a.o, F.col("rest").substr(a.k + 1, F.char_length("rest")))
    walked = F.aggregate(F.split(body, ""), F.struct(F.lit("").alias("o"), F.lit(0).alias("k")), lambda a, c: F.when(
        c.rlike(r"[\p{L}\p{N}]"), F.struct(F.concat(a.o, F.col("rest").substr(a.k + 1, F.lit(1))).alias("o"), (a.k + 1).alias("k"))
    ).otherwise(F.struct(F.concat(a.o, c).alias("o"), a.k.alias("k"))), tail)
    cased = F.when((F.upper(body) == F.col(body)) & (F.lower(body) != F.col(body)), F.upper(core)).otherwise(F.col(core))
    letters = F.array_join(F.zip_with(F.split(body, ""), F.split(core, ""), lambda m, c: F.when(m != F.lower(m), F.upper(c)).otherwise(c)), "")
    return (F.when(F.col("kind").isin("phone", "iban", "ssn", "card"), F.concat(fixed, walked))
            .when(F.col("kind") == "ip", F.col(core)).when(F.col("kind") == "person", F.concat(fixed, cased))
            .when(F.col("kind") == "email", letters).otherwise(F.concat(fixed, F.col(core))))


def replacements(mentions: DataFrame, key: str) -> DataFrame:
    """(mention, kind, surrogate) for distinct mentions."""
    known = stored(parts(mentions), "mentions")
    fixed = F.when(F.col("kind").isin("phone", "iban"), F.col("fixed")).otherwise(F.lit(""))
    entities = stored(known.select("kind", "canon", "gender", "script", fixed.alias("fixed")).distinct(), "entities")
    cores = assign(entities, key).select("kind", "canon", "gender", "script", "core")
    same = [F.col(f"m.{c}").eqNullSafe(F.col(f"s.{c}")) for c in ("kind", "canon", "gender", "script")]
    full = known.alias("m").join(cores.alias("s"), same).select("m.mention", "m.kind", "m.fixed", "m.body", "s.core")
    # digits after the fixed part, for the kinds that are written with separators
    full = full.withColumn("rest", F.when(F.col("kind").isin("phone", "iban"), F.expr("substring(core, char_length(fixed) + 1)")).otherwise(F.col("core")))
    return full.select("mention", "kind", rendered("mention", "fixed", "body", "core").alias("surrogate"))


def replace(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``text_col`` replaced, and n_entities, kinds (sorted)."""
    keys = [F.xxhash64(text_or_empty(text_col)).alias("k1"), F.xxhash64(F.lit("text"), text_or_empty(text_col)).alias("k2")]
    found = docs.select(*keys, F.regexp_extract_all(text_or_empty(text_col), F.lit(PATTERN), F.lit(0)).alias("found")).where(F.size("found") > 0)
    found = stored(found.groupBy("k1", "k2").agg(F.first("found").alias("found")), "found")
    each = found.select("k1", "k2", F.posexplode("found").alias("at", "mention"))
    table = stored(replacements(each.select("mention").distinct(), key), "replacements")
    new = each.join(table, "mention").groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("at", "surrogate", "kind"))).alias("new"))
    new = stored(new, "new")
    t = text_or_empty(F.col(f"`{text_col}`"))
    out = docs.join(small_side(new, new.count(), BROADCAST_ROWS), (F.xxhash64(t) == new.k1) & (F.xxhash64(F.lit("text"), t) == new.k2), "left")
    gaps = F.split(t, PATTERN, -1)
    text = F.array_join(F.flatten(F.zip_with(gaps, F.col("new.surrogate"), lambda g, s: F.array(g, F.coalesce(s, F.lit(""))))), "")
    return out.select(*[F.when(F.col("new").isNull(), F.col(text_col)).otherwise(text).alias(c) if c == text_col else docs[c] for c in docs.columns],
                      F.coalesce(F.size("new"), F.lit(0)).cast("long").alias("n_entities"),
                      F.coalesce(F.array_join(F.sort_array(F.array_distinct("new.kind")), ","), F.lit("")).alias("kinds"))
