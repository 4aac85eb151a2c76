"""Personal data replaced by surrogates, in DataFrame functions only.

Entities are found by patterns. Each gets a surrogate from a keyed digest of its kind and its canonical
form, so one entity has one surrogate wherever it stands and however it is written there; the surrogate
takes on the mention's own format. Surrogates are checked against each other and against all real
entities of the kind; who loses a clash draws again. Only entities that drew more than once travel
back to the documents; all others are computed where they stand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.llm.tables import stored

# Titles before names, by the gender that they tell.
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Mlle", "госпожа", "г-жа"]
MALE = ["Mr", "Herr", "Señor", "Sr", "Monsieur", "господин", "г-н"]
NEUTRAL = ["Dr", "Prof"]

# Syllables of surrogate names.
LATIN_HEADS = ["Bal", "Cor", "Dam", "Fel", "Gar", "Hal", "Jor", "Kel", "Lor", "Mar", "Nor", "Per", "Ros", "Sel", "Tam", "Ver"]
LATIN_JOINTS = ["an", "ed", "el", "en", "er", "il", "im", "in", "is", "ol", "on", "or", "um", "ur", "ad", "al"]
CYRILLIC_HEADS = ["Бал", "Вер", "Гор", "Дам", "Жар", "Зим", "Кор", "Лар", "Мир", "Нор", "Пет", "Рос", "Сав", "Тим", "Фед", "Яр"]
CYRILLIC_JOINTS = ["ал", "ан", "ар", "ел", "ен", "ер", "ил", "им", "ин", "ир", "ол", "он", "ор", "ум", "ун", "ур"]

_TITLE = "(?:" + "|".join(sorted(FEMALE + MALE + NEUTRAL, key=len, reverse=True)) + r")\.?"
_NAME = r"\p{Lu}[\p{L}'’-]*\p{Ll}"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# In order of preference where two begin at one place. Kinds are told apart again by ``kind_of``.
PATTERNS = {
    "email": r"[\p{L}\p{N}._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,5}\.[A-Za-z]{2,24}",
    "secret": r"(?<![0-9A-Za-z])[0-9a-fA-F]{32,}+(?![0-9A-Za-z])|(?<=(?i:token|secret|passwd|password|api.?key).{0,2}[:=]\s?[\"'])[^\s\"']{6,}+(?=[\"'])",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)",
    "phone": r"\+\d{1,3}[ .-]?(?:\(\d{1,5}\)[ .-]?)?\d{2,5}(?:[ .-]?\d{2,5}){1,4}\b|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}\b|\b\d{3}[.-]\d{3}[.-]\d{4}\b",
    "ssn": r"\b\d{3}-\d{2}-\d{4}\b",
    "card": r"\b\d{4}(?:[ -]\d{4}){3}\b|\b\d{13,19}\b",
    "person": rf"\b{_TITLE} {_NAME}(?: {_NAME}){{0,2}}",
}
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# Any entity holds a digit or an @, or begins with a title, or is quoted behind a word for secrets.
HINT = rf"[0-9@]|\b{_TITLE} \p{{Lu}}|(?i:token|secret|passwd|password|api.?key).{{0,2}}[:=]|[a-fA-F]{{32}}"
SEPARATOR = "\u001f"
MOST_DRAWS = 64


def kind_of(mention: Column) -> Column:
    found = F.when(mention.rlike(rf"^(?:{PATTERNS['email']})$"), "email")
    for kind in ("ip", "ssn"):
        found = found.when(mention.rlike(rf"^(?:{PATTERNS[kind].replace('(?<![0-9.])', '')})$"), kind)
    found = found.when(mention.rlike(rf"^{_TITLE} \p{{Lu}}"), "person")
    found = found.when(mention.rlike(r"^[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?$"), "iban")
    found = found.when(mention.rlike(r"^(?:\d{4}(?:[ -]\d{4}){3}|\d{13,19})$"), "card")
    return found.when(mention.rlike(r"^[+(\d][\d ().-]*$"), "phone").otherwise("secret")


def mentions_of(text: Column) -> Column:
    """All entities of a text in order, as they are written; a text without hints is not searched."""
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")


def parts_of(mention: Column) -> Column:
    """A mention as entities ``(kind, canon)``: a person's names are one each, others are one whole.

    The canonical form drops what is format: separators in numbers, letter case, and the female
    ending of Cyrillic surnames.
    """
    title = F.regexp_extract(mention, rf"^({_TITLE}) ", 1)
    bare = F.regexp_replace(title, r"\.$", "")
    gender = F.when(bare.isin(FEMALE), "female").when(bare.isin(MALE), "male").otherwise("any")
    names = F.split(F.substring(mention, F.length(title) + 2, F.length(mention)), " ")

    def person(name: Column, i: Column) -> Column:
        given = (F.size(names) > 1) & (i < F.size(names) - 1)
        kind = F.concat_ws("-", F.when(given, F.concat(F.lit("given-"), gender)).otherwise("surname"), _script(name))
        lower = F.lower(name)
        stem = F.when(~given & (_script(name) == "cyrillic"), F.regexp_replace(lower, "а$", "")).otherwise(lower)
        return F.struct(kind.alias("kind"), stem.alias("canon"))

    kind = kind_of(mention)
    canon = (
        F.when(kind == "email", F.lower(mention))
        .when(kind.isin("iban"), F.upper(F.regexp_replace(mention, " ", "")))
        .when(kind.isin("card", "ssn"), F.regexp_replace(mention, r"\D", ""))
        .when(kind == "phone", F.regexp_replace(mention, r"[^\d+]", ""))
        .otherwise(mention)
    )
    return F.when(kind == "person", F.transform(names, person)).otherwise(F.array(F.struct(kind.alias("kind"), canon.alias("canon"))))


def _digits_sum(digits: Column, doubled_if_odd: Column) -> Column:
    """Luhn sum; a digit is doubled where its distance from the right has the parity of ``doubled_if_odd``."""
    chars = F.split(digits, "")
    return F.aggregate(
        F.transform(
            chars,
            lambda c, i: F.when((F.size(chars) - 1 - i) % 2 == doubled_if_odd, (c.cast("int") * 2) - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(
                c.cast("int")
            ),
        ),
        F.lit(0),
        lambda a, x: a + x,
    )


def _digest(key: str, kind: Column, canon: Column, draw: Column) -> Column:
    return F.sha2(F.concat_ws(SEPARATOR, F.lit(key), kind, canon, draw.cast("string")), 512)


def _number(digest: Column, at: Column) -> Column:
    """A number from 0 to 65535 from the hex digits at place ``at``, cyclically."""
    return F.conv(F.substring(digest, (at * 4) % 124 + 1, F.lit(4)), 16, 10).cast("int")


def _same_shape(canon: Column, digest: Column) -> Column:
    """Letters for letters and digits for digits, by script and case; other characters stay."""

    def one(c: Column, i: Column) -> Column:
        n = (_number(digest, i) + i) % 65521
        latin, cyrillic = F.lit("abcdefghijklmnopqrstuvwxyz"), F.lit("абвгдежзиклмнопрстуфхцчшэюя")
        letter = F.when(c.rlike(r"\p{IsCyrillic}"), F.substring(cyrillic, n % 27 + 1, F.lit(1))).otherwise(F.substring(latin, n % 26 + 1, F.lit(1)))
        return (
            F.when(c.rlike(r"\p{Nd}"), (n % 10).cast("string"))
            .when(c.rlike(r"\p{Lu}"), F.upper(letter))
            .when(c.rlike(r"\p{L}"), letter)
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(canon, ""), one), "")


def _name(kind: Column, digest: Column, draw: Column, canon: Column) -> Column:
    """A made-up name of the script and gender; later draws have more syllables, so names never run out."""
    cyrillic = kind.endswith("cyrillic")

    def pick(items: list[str], at: Column) -> Column:
        return F.element_at(F.array(*map(F.lit, items)), _number(digest, at) % len(items) + 1)

    head = F.when(cyrillic, pick(CYRILLIC_HEADS, F.lit(0))).otherwise(pick(LATIN_HEADS, F.lit(0)))
    # Two syllables at least, and as many more as eight names would differ by.
    joints = F.transform(
        F.sequence(F.lit(1), F.lit(4) + draw),
        lambda i: F.when(cyrillic, pick(CYRILLIC_JOINTS, i)).otherwise(pick(LATIN_JOINTS, i)),
    )
    end = (
        F.when(kind.startswith("surname"), F.when(cyrillic, "ов").otherwise(""))
        .when(kind.startswith("given-female"), F.when(cyrillic, "а").otherwise("a"))
        .when(kind.startswith("given-male"), F.when(cyrillic, "").otherwise("o"))
        .otherwise(F.when(cyrillic, "ь").otherwise("is"))
    )
    return F.lower(F.concat(head, F.array_join(joints, ""), end))


def surrogate_of(key: str, kind: Column, canon: Column, draw: Column) -> Column:
    """The canonical form of an entity's surrogate at its ``draw``-th draw, from 0."""
    digest = _digest(key, kind, canon, draw)
    shaped = _same_shape(canon, digest)
    longer = F.when(draw > 7, F.substring(digest, 1, draw - 7)).otherwise("")
    local, domain = F.substring_index(shaped, "@", 1), F.substring_index(shaped, "@", -1)
    top = F.substring_index(canon, ".", -1)
    email = F.concat(local, longer, F.lit("@"), F.substring(domain, F.lit(1), F.length(domain) - F.length(top)), top)
    # A card keeps its first digit, and whether its check digit is right.
    body = F.concat(F.substring(canon, 1, 1), F.substring(shaped, F.lit(2), F.length(canon) - 2))
    right = ((10 - _digits_sum(body, F.lit(0)) % 10) % 10)
    sound = _digits_sum(canon, F.lit(1)) % 10 == 0
    check = F.when(sound, right).otherwise((right + 1 + _number(digest, F.lit(30)) % 9) % 10)
    card = F.concat(body, check.cast("string"))
    country = F.regexp_extract(canon, r"^\+(?:1|7|[2-9]\d)", 0)
    phone = F.concat(country, F.substring(shaped, F.length(country) + 1, F.length(shaped)))
    ip = F.concat_ws(
        ".",
        *((_number(digest, F.lit(at)) % 223 + 1 if at == 0 else _number(digest, F.lit(at)) % 256).cast("string") for at in range(4)),
    )
    iban = F.concat(F.substring(canon, 1, 2), F.substring(shaped, F.lit(3), F.length(canon)))
    # A digest of 128 hex digits for each stretch of the secret.
    more = F.transform(
        F.sequence(F.lit(0), F.floor(F.length(canon) / 128).cast("int")),
        lambda i: F.when(i == 0, digest).when(i == 1, F.sha2(digest, 512)).otherwise(F.sha2(F.concat(digest, i.cast("string")), 512)),
    )
    hexes = F.substring(F.array_join(more, ""), F.lit(1), F.length(canon))
    secret = F.when(canon.rlike("^[0-9a-f]+$"), hexes).when(canon.rlike("^[0-9A-F]+$"), F.upper(hexes)).otherwise(shaped)
    return (
        F.when(kind == "email", email)
        .when(kind == "card", card)
        .when(kind == "phone", phone)
        .when(kind == "ip", ip)
        .when(kind == "iban", iban)
        .when(kind == "ssn", shaped)
        .when(kind == "secret", secret)
        .otherwise(_name(kind, digest, draw, canon))
    )


def _in_format(mention: Column, kind: Column, surrogates: Column) -> Column:
    """Surrogates in the format of the mention: separators, case, title and Cyrillic endings."""
    first = F.get(surrogates, F.lit(0))
    chars = F.split(mention, "")

    def fill(state: Column, c: Column) -> Column:
        own = c.rlike("[0-9A-Z+]")
        return F.struct(
            F.concat(state["text"], F.when(own, F.substring(first, state["at"], F.lit(1))).otherwise(c)).alias("text"),
            (state["at"] + own.cast("int")).alias("at"),
        )

    filled = F.aggregate(chars, F.struct(F.lit("").alias("text"), F.lit(1).alias("at")), fill, lambda s: s["text"])
    cased = F.when((F.upper(mention) == mention) & (F.lower(mention) != mention), F.upper(first)).otherwise(first)
    title = F.regexp_extract(mention, rf"^({_TITLE}) ", 1)
    names = F.split(F.substring(mention, F.length(title) + 2, F.length(mention)), " ")
    ending = F.zip_with(
        surrogates,
        names,
        lambda s, n: F.concat(
            F.upper(F.substring(s, 1, 1)),
            F.substring(s, F.lit(2), F.length(s)),
            F.when(s.endswith("ов") & n.endswith("а"), "а").otherwise(""),
        ),
    )
    person = F.concat(title, F.lit(" "), F.array_join(ending, " "))
    return (
        F.when(kind == "person", person)
        .when(kind == "email", cased)
        .when(kind.isin("card", "phone", "ssn", "iban"), filled)
        .otherwise(first)
    )


def entity_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``(kind, canon, draw, surrogate)`` for distinct ``entities (kind, canon)``, with no clash.

    Within a kind no two entities share a surrogate, and none is itself a real entity. Whoever has
    settled keeps the surrogate; of those that draw at once the smallest canonical form wins.
    """
    columns = ["kind", "canon", "draw", "surrogate", "settled"]
    state = entities.select("kind", "canon", F.lit(0).alias("draw")).select(
        "*", surrogate_of(key, F.col("kind"), F.col("canon"), F.col("draw")).alias("surrogate"), F.lit(False).alias("settled")
    )
    state = stored(state, "surrogates")
    real = entities.select("kind", F.col("canon").alias("surrogate"), F.lit(True).alias("real"))
    for _ in range(MOST_DRAWS):
        claims = state.groupBy("kind", "surrogate").agg(F.min(F.struct(~F.col("settled"), "canon")).alias("first"))
        taken = state.join(claims, ["kind", "surrogate"]).join(real, ["kind", "surrogate"], "left")
        settled = (F.col("first.canon") == F.col("canon")) & F.col("real").isNull()
        taken = stored(taken.withColumn("settled", settled).select(columns), "surrogates")
        if taken.filter("NOT settled").isEmpty():
            return taken.drop("settled")
        again = F.when(F.col("settled"), F.col("draw")).otherwise(F.col("draw") + 1)
        state = stored(
            taken.withColumn("draw", again)
            .withColumn(
                "surrogate",
                F.when(F.col("settled"), F.col("surrogate")).otherwise(surrogate_of(key, F.col("kind"), F.col("canon"), F.col("draw"))),
            )
            .select(columns),
            "surrogates",
        )
    raise ValueError(f"no free surrogates after {MOST_DRAWS} draws: too many entities for their format")


def replace_entities(docs: DataFrame, key: str, text_column: str = "text") -> DataFrame:
    """``docs`` with surrogates in the text, and ``n_entities`` (mentions replaced) and ``entity_kinds`` besides.

    Everything else of a text stays as it is, and so does a text without entities; a null text stays
    null and has none. Equal rows stay equal, and an empty table is an empty result. Other columns
    are passed on; ones named ``n_entities`` or ``entity_kinds`` are replaced.
    """
    text = F.col(text_column)
    names = [c for c in docs.columns if c not in ("n_entities", "entity_kinds")]
    # Draws beyond the first are looked up by the text's digest: rows need no key.
    found = docs.filter(text.rlike(HINT)).select(F.md5(text.cast("binary")).alias("_text"), mentions_of(text).alias("mentions"))
    parts = found.select("_text", F.explode(F.flatten(F.transform("mentions", parts_of))).alias("e")).select("_text", "e.kind", "e.canon")
    parts = stored(parts.distinct(), "entities")
    surrogates = entity_surrogates(parts.select("kind", "canon").distinct(), key)
    later = parts.join(surrogates.filter("draw > 0"), ["kind", "canon"])
    entry = F.struct(F.concat_ws(SEPARATOR, "kind", "canon"), "draw")
    draws = later.groupBy("_text").agg(F.map_from_entries(F.collect_list(entry)).alias("_draws"))
    rows = docs.select(names)
    if draws.isEmpty():
        rows = rows.withColumn("_draws", F.lit(None).cast("map<string,int>"))
    else:
        rows = rows.withColumn("_text", F.when(text.rlike(HINT), F.md5(text.cast("binary")))).join(draws, "_text", "left")

    def draw_of(part: Column) -> Column:
        drawn = F.try_element_at(F.col("_draws"), F.concat_ws(SEPARATOR, part["kind"], part["canon"]))
        return F.coalesce(drawn, F.lit(0))

    def replaced(mention: Column) -> Column:
        own = F.transform(parts_of(mention), lambda p: surrogate_of(key, p["kind"], p["canon"], draw_of(p)))
        return _in_format(mention, kind_of(mention), own)

    rows = rows.withColumn("_mentions", mentions_of(text))
    between = F.split(text, ENTITY, -1)
    joined = F.array_join(
        F.zip_with(between, F.transform("_mentions", replaced), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), ""
    )
    new_text = F.when(F.size("_mentions") > 0, joined).otherwise(text)
    return rows.select(
        *(new_text.alias(c) if c == text_column else F.col(c) for c in names),
        F.when(text.isNull(), 0).otherwise(F.size("_mentions")).cast("bigint").alias("n_entities"),
        F.array_sort(F.array_distinct(F.transform(F.coalesce("_mentions", F.array().cast("array<string>")), kind_of))).alias("entity_kinds"),
    )
