"""PII replaced by surrogates, in DataFrame operations only.

Method.  One expression finds e-mail addresses, payment cards, phone numbers,
IP addresses, account numbers, access keys, quoted hexadecimal secrets and
titled names.  The different entities of all texts form a table; each gets a
surrogate made from a keyed hash of its type and normalised value, so an entity
has the same surrogate in every text and run, however it is written
(coreference): cards, phones and accounts are told by their letters and digits,
addresses in lower case, and each mention is written in its own form.  Parts of
a titled name that recur without title in the same text are replaced too.  A
given name behind a title of either gender is the one behind the other titles,
where the texts hold it for one gender only.  Surrogates keep the form: letters stay letters of the
same case and script, digits stay digits, marks stay; cards keep their check
digit right, phones their country prefix, names the gender of their title.
A surrogate that equals another entity's surrogate or any real entity is drawn
again with the next attempt number until all differ (distinctness).  Names grow
by a syllable with each attempt, so their supply never ends; what keeps its
format (addresses, numbers) has as many surrogates as the format has values.

The texts are then cut at the entities and put together with the surrogates.
Only texts with an entity take part in a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import table
from cartwheel.session import staged

#: Key of the hash; whoever knows it can repeat the mapping.  A parameter.
KEY = "surrogates-1"
MAX_ATTEMPTS = 50

# Titles by gender: f, m, or u for either.
TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mademoiselle", "Mlle", "Señora", "Sra", "Doña", "Госпожа", "Κυρία"),
    "m": ("Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Don", "Господин", "Κύριος"),
    "u": ("Dr", "Prof"),
}
# Given names by script and gender.
GIVEN = {
    "latin": {
        "f": ("Clara", "Emma", "Julia", "Laura", "Marie", "Nora", "Paula", "Sara", "Sofia", "Vera", "Alma", "Ines"),
        "m": ("Adam", "Bruno", "David", "Felix", "Hugo", "Leon", "Marco", "Oscar", "Pablo", "Simon", "Tomas", "Victor"),
    },
    "cyrillic": {"f": ("Анна", "Вера", "Мария", "Нина", "Ольга", "Софья"), "m": ("Антон", "Борис", "Иван", "Максим", "Олег", "Павел")},
    "greek": {"f": ("Άννα", "Ελένη", "Μαρία", "Νίκη", "Σοφία", "Χαρά"), "m": ("Ανδρέας", "Γιώργος", "Λεωνίδας", "Νίκος", "Παύλος", "Πέτρος")},
}
# Consonants and vowels of made-up surnames.
SYLLABLES = {
    "latin": ("bdfglmnprstv", "aeiou"),
    "cyrillic": ("бвгдзклмнпрст", "аеиоу"),
    "greek": ("βγδζκλμνπρστ", "αειου"),
}
LETTERS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшя", "greek": "αβγδεζηθικλμνξοπρστυφχω"}

_TITLE = "|".join(t for titles in TITLES.values() for t in titles)
# Possessive quantifiers and the look-behinds keep the scan linear.
EMAIL = r"(?<![\w.%+-])[\w.%+-]++(?<!\.)@(?:[\p{L}\p{N}-]++\.)+\p{L}{2,}"
CARD = r"(?<![\w.-])(?:\d{16}|\d{4}(?:[ -]\d{4}){3}|3[47]\d{2}[ -]?\d{6}[ -]?\d{5})(?![\w-])"
PHONE = r"(?<![\w+.])(?:\+\d{1,3}[ .-]?)(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\w)|(?<![\w+.])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?!\w)"
IP = r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d)"
IDENTITY = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
ACCOUNT = r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"
ACCESS = r"(?<!\w)(?:AKIA|ASIA)[A-Z0-9]{16}(?!\w)"
SECRET = (
    r"(?<=[\"'])(?<=(?:token|secret|key|password|passwd)[\"']?\s{0,3}[:=]\s{0,3}[\"'])[0-9A-Fa-f]{16,}+(?=[\"'])"
)
NAME = rf"(?<![\p{{L}}\p{{N}}])(?:{_TITLE})\.?(?: \p{{Lu}}[\p{{L}}'’-]++){{1,3}}"
KINDS = {"email": EMAIL, "access": ACCESS, "account": ACCOUNT, "card": CARD, "identity": IDENTITY, "ip": IP, "phone": PHONE, "secret": SECRET, "name": NAME}
# A quoted secret goes first: its digits are no card.
ANY = "|".join(f"(?:{p})" for p in [SECRET, *KINDS.values()])
#: Kinds whose mentions differ in marks or case only.
WRITTEN = ("email", "card", "phone", "account")
# Country prefixes of one, two and three digits.
COUNTRY = r"^(\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})|)"
#: What every entity holds: spares most texts the long expression.
HINT = rf"[@\d]|\b(?:{_TITLE})\b"


def mentions(text: Column) -> Column:
    """Entities of a text in order; empty for NULL or none."""
    none = F.array().cast("array<string>")
    return F.coalesce(F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))), none)


def kind_of(value: Column) -> Column:
    """Type of an entity, by the expression that covers all of it."""
    kind = F.lit("name")
    # What is before a secret is not part of it.
    for name, pattern in reversed((KINDS | {"secret": "[0-9A-Fa-f]{16,}"}).items()):
        kind = F.when(value.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(kind)
    return kind


def script_of(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _stream(*seed: Column) -> Column:
    """256 keyed hash digits to draw from."""
    text = F.concat_ws("\x1f", *seed)
    return F.concat(F.sha2(F.concat(text, F.lit("\x1f0")), 512), F.sha2(F.concat(text, F.lit("\x1f1")), 512))


def _drawn(stream: Column, i: Column, choices: str | tuple) -> Column:
    """The i-th choice: three hash digits, modulo the number of choices."""
    number = F.conv(F.substr(stream, F.pmod(i * 3, F.lit(252)) + 1, F.lit(3)), 16, 10).cast("int")
    return F.element_at(F.array(*[F.lit(c) for c in choices]), F.pmod(number, F.lit(len(choices))) + 1)


def _scrambled(value: Column, stream: Column) -> Column:
    """Same length, marks, case and script, other letters and digits."""

    def one(c: Column, i: Column) -> Column:
        lower = F.lower(c)
        letter = _drawn(stream, i, LETTERS["latin"])
        for script, pattern in (("cyrillic", r"\p{IsCyrillic}"), ("greek", r"\p{IsGreek}")):
            letter = F.when(c.rlike(pattern), _drawn(stream, i, LETTERS[script])).otherwise(letter)
        return (
            F.when(c.rlike(r"\d"), _drawn(stream, i, "0123456789"))
            .when(~c.rlike(r"\p{L}"), c)
            .when(lower == c, letter)
            .otherwise(F.upper(letter))
        )

    return F.array_join(F.transform(F.filter(F.split(value, ""), lambda c: c != ""), one), "")


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit text, its last digit being the check digit."""
    reverse = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    parts = F.transform(
        reverse,
        lambda c, i: F.when(i % 2 == 1, (c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5)).otherwise(c.cast("int")).cast("int"),
    )
    return F.aggregate(parts, F.lit(0), lambda total, x: total + x)


def _card(value: Column, stream: Column) -> Column:
    """First digit kept; a right check digit stays right."""
    drawn = F.concat(F.substr(value, F.lit(1), F.lit(1)), F.substr(_scrambled(value, stream), F.lit(2)))
    digits = F.regexp_replace(drawn, r"\D", "")
    last = F.substr(digits, F.length(digits), F.lit(1)).cast("int")
    check = F.pmod(last - _luhn_sum(digits), F.lit(10)).cast("string")
    right = _luhn_sum(F.regexp_replace(value, r"\D", "")) % 10 == 0
    return F.when(right, F.concat(F.substr(drawn, F.lit(1), F.length(drawn) - 1), check)).otherwise(drawn)


def _ip(stream: Column) -> Column:
    octet = lambda i: (F.conv(F.substr(stream, F.lit(8 * i + 1), F.lit(7)), 16, 10).cast("long") % 254 + 1).cast("string")
    return F.concat_ws(".", *[octet(i) for i in range(4)])


def _email(value: Column, stream: Column, key: Column, attempt: Column) -> Column:
    """Name and host part apart: addresses of one host stay together."""
    host = F.regexp_extract(value, r"@(.*)\.[^.]+$", 1)
    end = F.regexp_extract(value, r"(\.[^.]+)$", 1)
    local = F.regexp_extract(value, r"^([^@]*)@", 1)
    return F.concat(_scrambled(local, stream), F.lit("@"), _scrambled(host, _stream(key, F.lit("host"), F.lower(host))), end)


def _syllables(script: str, stream: Column, at: int, count: Column) -> Column:
    """``count`` syllables drawn from place ``at`` on."""
    consonants, vowels = SYLLABLES[script]
    one = lambda i: F.concat(_drawn(stream, at + 2 * i, consonants), _drawn(stream, at + 2 * i + 1, vowels))
    return F.array_join(F.transform(F.sequence(F.lit(0), count - 1), one), "")


def _surname(word: Column, stream: Column, attempt: Column) -> Column:
    """Four syllables, and one more with each attempt: the supply grows with
    the need."""
    made = F.lit("")
    for script in SYLLABLES:
        text = _syllables(script, stream, 0, 4 + attempt)
        made = F.when(script_of(word) == script, F.initcap(text)).otherwise(made)
    return F.when(word == F.upper(word), F.upper(made)).otherwise(made)


def _given(word: Column, gender: Column, stream: Column, attempt: Column) -> Column:
    """A name of the gender with two more syllables, and one more with each
    attempt: the supply grows with the need."""
    made = F.lit("")
    for script, names in GIVEN.items():
        either = names["f"] + names["m"]
        drawn = F.when(gender == "f", _drawn(stream, F.lit(0), names["f"])).when(gender == "m", _drawn(stream, F.lit(0), names["m"]))
        ending = _syllables(script, stream, 4, 2 + attempt)
        full = F.concat(drawn.otherwise(_drawn(stream, F.lit(0), either)), F.lit("-"), F.initcap(ending))
        made = F.when(script_of(word) == script, full).otherwise(made)
    return made


def _gender(title: Column) -> Column:
    bare = F.regexp_replace(title, r"\.$", "")
    return F.when(bare.isin(*TITLES["f"]), "f").when(bare.isin(*TITLES["m"]), "m").otherwise("u")


def normal(value: Column, kind: Column) -> Column:
    """The value by which mentions of one entity are told."""
    return (
        F.when(kind == "email", F.lower(value))
        .when(kind == "card", F.regexp_replace(value, r"\D", ""))
        .when(kind == "phone", F.regexp_replace(value, r"[^\d+]", ""))
        .when(kind == "account", F.regexp_replace(value, " ", ""))
        .otherwise(value)
    )


def _written(made: Column, mention: Column) -> Column:
    """A surrogate in the marks and case of the mention."""
    chars = F.filter(F.split(made, ""), lambda c: c.rlike(r"[\p{L}\p{N}]"))
    own = F.filter(F.split(mention, ""), lambda c: c != "")
    told = lambda c: c.rlike(r"[\p{L}\p{N}]")
    before = lambda i: F.size(F.filter(F.slice(own, 1, i), told))
    form = lambda c, x: F.when(c == F.lower(c), x).otherwise(F.upper(x))
    return F.array_join(F.transform(own, lambda c, i: F.when(told(c), form(c, F.get(chars, before(i)))).otherwise(c)), "")


def parts_of(value: Column, kind: Column) -> Column:
    """``kind, value`` of the parts that are mapped: a name's given names and
    surname apart, anything else whole."""
    words = F.split(value, " ")
    named = F.transform(
        F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(1))),
        lambda w, i: F.struct(
            F.when(i == F.size(words) - 2, F.lit("surname")).otherwise(F.concat(F.lit("given_"), _gender(words[0]))).alias("kind"),
            w.alias("value"),
        ),
    )
    return F.when(kind == "name", named).otherwise(F.array(F.struct(kind.alias("kind"), normal(value, kind).alias("value"))))


def surrogate(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """The replacement of one part at one attempt."""
    secret = F.lit(key)
    # A family name is one entity in either case.
    stream = _stream(secret, kind, F.when(kind == "surname", F.lower(value)).otherwise(value), attempt.cast("string"))
    scrambled = _scrambled(value, stream)
    prefix = lambda pattern: F.regexp_extract(value, pattern, 1)
    keep = lambda kept: F.concat(kept, F.substr(scrambled, F.length(kept) + 1))
    return (
        F.when(kind == "email", _email(value, stream, secret, attempt))
        .when(kind == "card", _card(value, stream))
        .when(kind == "ip", _ip(stream))
        .when(kind == "phone", keep(prefix(COUNTRY)))
        .when(kind == "account", keep(prefix(r"^([A-Z]{2})")))
        .when(kind == "access", keep(prefix(r"^(....)")))
        .when(kind == "surname", _surname(value, stream, attempt))
        .when(kind.startswith("given_"), _given(value, F.substr(kind, F.lit(7)), stream, attempt))
        .otherwise(scrambled)
    )


def surrogates(parts: DataFrame, key: str = KEY) -> DataFrame:
    """``kind, value, surrogate`` of the different parts, all surrogates of a
    kind different from each other and from every real value.

    The first of several claimants (by value) keeps a surrogate, the others
    draw again.
    """
    entities = staged(parts.select("kind", "value").distinct(), "entities")
    drawn = lambda df: df.withColumn("surrogate", surrogate(F.col("kind"), F.col("value"), F.col("attempt"), key))
    real = entities.select(F.lower("value").alias("claimed")).distinct().withColumn("real", F.lit(True))
    current = staged(drawn(entities.withColumn("attempt", F.lit(0))), "surrogates")
    for _ in range(MAX_ATTEMPTS):
        # Spellings of one surname share a surrogate but for the case.
        claim = F.lower("surrogate")
        owner = F.when(F.col("kind") == "surname", F.lower("value")).otherwise(F.col("value"))
        first = current.groupBy("kind", claim.alias("claimed")).agg(F.min(owner).alias("first_owner"))
        judged = (
            current.withColumn("claimed", claim)
            .join(first, ["kind", "claimed"])
            .join(real, "claimed", "left")
            .withColumn("taken", F.coalesce("real", F.lit(False)) | (owner != F.col("first_owner")))
        )
        if not judged.where("taken").limit(1).count():
            return current.select("kind", "value", "surrogate")
        again = judged.withColumn("attempt", F.col("attempt") + F.col("taken").cast("int")).select("kind", "value", "attempt")
        current = staged(drawn(again), "surrogates")
    raise RuntimeError("surrogates did not become distinct")


def _untitled(text: Column, names: Column) -> Column:
    """The text with each capitalised word exchanged that the map ``names``
    holds in lower case."""

    def exchanged(word: Column) -> Column:
        name = F.try_element_at(names, F.lower(word))
        cased = F.when((F.length(word) > 1) & (word == F.upper(word)), F.upper(name)).otherwise(name)
        return F.when(word.rlike(r"^\p{Lu}"), F.coalesce(cased, word)).otherwise(word)

    words = F.split(text, r"(?<![\p{L}\p{N}-])(?=\p{Lu})|(?<=\p{L})(?![\p{L}\p{N}-])", -1)
    return F.when(names.isNull(), text).otherwise(F.array_join(F.transform(words, exchanged), ""))


def _replaced(text: Column, found: Column, known: Column, names: Column) -> Column:
    """The text with each mention exchanged through the map ``known``, and
    untitled names between them through the map ``names``."""

    def exchanged(mention: Column) -> Column:
        kind = kind_of(mention)
        made = F.try_element_at(known, F.concat_ws("\x1f", kind, normal(mention, kind)))
        whole = F.when(kind.isin(*WRITTEN), _written(made, mention)).otherwise(made)
        words = F.split(mention, " ")
        name = F.concat_ws(
            " ",
            words[0],
            F.transform(parts_of(mention, kind), lambda p: F.try_element_at(known, F.concat_ws("\x1f", p["kind"], p["value"]))),
        )
        return F.when(kind == "name", name).otherwise(whole)

    between = F.transform(F.split(text, ANY, -1), lambda x: _untitled(x, names))
    return F.array_join(
        F.zip_with(between, F.transform(found, exchanged), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), ""
    )


def replace_pii(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with every entity in ``text`` replaced; same columns and rows.

    NULL and empty texts, and texts without an entity, stay as they are.
    Equal texts stay equal.  Other columns pass through untouched, whatever
    their names; rows are told by their text alone, so repeated rows and NULL
    ids need no care.  No rows in, no rows out.
    """
    columns = docs.columns
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    # Only texts with an entity are written, hashed and shuffled.
    holds = F.coalesce(F.col("row.text").rlike(HINT), F.lit(False)) & (F.size(mentions(F.col("row.text"))) > 0)
    found = staged(
        whole.where(holds).select("row", F.md5("row.text").alias("text_key"), mentions(F.col("row.text")).alias("found")), "mentions"
    )
    spread = found.select("text_key", F.explode(F.array_distinct("found")).alias("mention"))
    parts = staged(
        spread.withColumn("kind", kind_of(F.col("mention")))
        .select("text_key", F.explode(parts_of(F.col("mention"), F.col("kind"))).alias("part"))
        .select("text_key", "part.kind", "part.value")
        .distinct(),
        "parts",
    )
    # Names behind titles of either gender, where the texts tell it.
    told = parts.where(F.col("kind").isin("given_f", "given_m")).groupBy("value").agg(
        F.min("kind").alias("least"), F.max("kind").alias("most")
    )
    one = told.where("least = most").select(F.lit("given_u").alias("kind"), "value", F.col("least").alias("as_kind"))
    parts = staged(
        parts.join(one, ["kind", "value"], "left").select("text_key", "kind", "value", F.coalesce("as_kind", "kind").alias("as_kind")),
        "parts",
    )
    mapped = surrogates(parts.select(F.col("as_kind").alias("kind"), "value"), key).withColumnRenamed("kind", "as_kind")
    # Equal texts share one map; its size is bounded by the text.
    entry = F.struct(F.concat_ws("\x1f", "kind", "value"), "surrogate")
    word = F.when(
        F.col("kind") == "surname", F.struct(F.lower("value").alias("name"), F.initcap("surrogate").alias("surrogate"))
    ).when(F.col("kind").startswith("given_"), F.struct(F.lower("value").alias("name"), F.col("surrogate")))
    maps = (
        parts.join(mapped, ["as_kind", "value"])
        .groupBy("text_key")
        .agg(F.map_from_entries(F.collect_list(entry)).alias("known"), F.array_sort(F.collect_set(word)).alias("words"))
        # A word that stands for several names is the first of them.
        .withColumn(
            "words", F.filter("words", lambda x, i: (i == 0) | (F.get(F.col("words"), i - 1)["name"] != x["name"]))
        )
        .select("text_key", "known", F.when(F.size("words") > 0, F.map_from_entries("words")).alias("names"))
    )
    changed = found.join(maps, "text_key").select(
        F.col("row").withField("text", _replaced(F.col("row.text"), F.col("found"), F.col("known"), F.col("names"))).alias("row")
    )
    return whole.where(~holds).unionByName(changed).select(*[F.col("row").getField(c).alias(c) for c in columns])


def op10_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with its entities replaced."""
    return replace_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
