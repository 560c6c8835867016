"""Surrogates for personal data, in DataFrame functions only.

Entities (e-mail addresses, IPv4 addresses, card numbers with a valid check digit, phone numbers, secrets
after a key word, and names after a title) are replaced by keyed surrogates of the same type: the same entity
always gets the same surrogate (coreference), written in the format, script and case of each mention, with a valid
check digit for cards, and with an ending of the same gender for given names. The words of a name
are entities of their own, so "Mrs Roe" and "Mrs Ann Roe" keep one family name.

A surrogate is computed in place from the key and the entity alone, so texts are not shuffled.
All distinct entities are then checked for collisions: where two would share a surrogate,
or a surrogate is itself an entity of the texts, all but the first get another one. From the second new one on
they are longer each time, so no format runs dry: e-mail addresses, secrets and names grow by letters, and from the
fourth on IPv4 addresses get a port, card and phone numbers an extension. Only these exceptions, as a rule
none, are joined back to the places where they occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trainlake.llm.common import fresh
from trainlake.session import materialise

# Titles before names.
MALE = "Mr|Herr|Monsieur|Señor|Господин"
FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Госпожа"
# Words before secrets.
SECRET_WORDS = "password|passwd|pwd|token|secret|api_key|apikey|access_key"

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
IP = rf"(?=\d)(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?![\d.]*\d)"
SECRET = rf"(?<=[=:\"'\s])(?=[A-Za-z0-9_+/\-]{{8}})(?=[_+/\-]*[A-Za-z0-9])(?<=[=:]\s{{0,2}}[\"']?)(?<=\b(?i:{SECRET_WORDS})[\"']?\s{{0,2}}[=:]\s{{0,2}}[\"']?)[A-Za-z0-9_+/\-]{{8,}}"
CARD = r"(?=[3-6])(?<![\w.+-])[3-6]\d{3}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\w-])"
PHONE = r"(?=[+(0-9])(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\w)"
NAME = rf"(?=[FHMSГ])\b(?:{MALE}|{FEMALE})\.? \p{{Lu}}\p{{L}}+(?: \p{{Lu}}\p{{L}}+)?"
ENTITY = f"{EMAIL}|{SECRET}|{IP}|{CARD}|{PHONE}|{NAME}"
#: What every entity holds or follows; texts without it need no closer look.
HINT = rf"[@0-9=:]|(?:{MALE}|{FEMALE})\.? \p{{Lu}}"
#: What stands before a secret.
BEFORE_SECRET = rf"\b(?i:{SECRET_WORDS})[\"']?\s{{0,2}}[=:]\s{{0,2}}[\"']?$"
#: The turn from which numbers get an extension.
EXTENDED = 4
CONSONANTS, VOWELS = "bcdfghjklmnprstvwz", "aeiou"
CYRILLIC_CONSONANTS, CYRILLIC_VOWELS = "бвгджзклмнпрстфхц", "аеиоу"


def kind(mention: Column, before: Column) -> Column:
    """The type of a mention, by its form; numbers like those of cards without a valid check digit are secrets after a key word, and else nothing."""
    digits = F.regexp_replace(mention, r"\D", "")
    return (
        F.when(mention.contains("@"), "email")
        .when(mention.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"), "ip")
        .when(mention.rlike(rf"^(?:{FEMALE})\b"), "female")
        .when(mention.rlike(rf"^(?:{MALE})\b"), "male")
        .when(mention.rlike(r"^[3-6]\d{3}(?:[ -]?\d{4}){2}[ -]?\d{1,7}$"), F.when(_luhn(digits) % 10 == 0, "card").when(F.right(before, F.lit(60)).rlike(BEFORE_SECRET), "secret").otherwise("none"))
        .when(mention.rlike(r"^[+(]|^\d{3}[ .-]\d{3}[ .-]\d{4}$"), "phone")
        .otherwise("secret")
    )


def parts(mention: Column, what: Column) -> Column:
    """The entities of a mention, each with its type: what mentions of one entity have in common; names have one for each word."""
    digits = F.regexp_replace(mention, r"\D", "")
    whole = (
        F.when(what == "email", F.lower(mention))
        .when(what == "card", digits)
        .when(what == "phone", F.when(F.length(digits) > 10, F.substring(digits, -10, 10)).otherwise(digits))
        .otherwise(mention)
    )
    words = F.split(F.lower(F.regexp_replace(mention, r"^\S+ ", "")), " ")
    named = F.transform(words, lambda w, i: F.struct(F.when((i == 0) & (F.size(words) > 1), F.concat(F.lit("given "), what)).otherwise(F.lit("family")).alias("what"), w.alias("entity")))
    return F.when(what == "none", F.array().cast("array<struct<what:string,entity:string>>")).when(what.isin("female", "male"), named).otherwise(F.array(F.struct(what.alias("what"), whole.alias("entity"))))


def _pick(seed: Column, at: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(seed, at), F.lit(n)).cast("int")


def _letters(seed: Column, text: Column, keep: Column | None = None) -> Column:
    """Every digit by a digit, every letter by a letter of its script and case; the rest, and the last ``keep`` characters, stay."""
    from_, ranges = F.split(text, ""), (("[0-9]", 48, 10), ("[a-z]", 97, 26), ("[A-Z]", 65, 26), ("[а-я]", 0x430, 32), ("[А-Я]", 0x410, 32), ("[α-ρσ-ω]", 0x3B1, 17))

    hexadecimal = text.rlike("^[0-9a-f]+$")

    def one(c: Column, i: Column) -> Column:
        out = F.when(hexadecimal & c.rlike("^[a-f]$"), F.substring(F.lit("abcdef"), _pick(seed, i, 6) + 1, F.lit(1)))
        if keep is not None:
            out = out.when(i >= F.length(text) - keep, c)
        for pattern, first, n in ranges:
            alphabet = F.lit("".join(map(chr, range(first, first + n))))
            out = out.when(c.rlike(f"^{pattern}$"), F.substring(alphabet, _pick(seed, i, n) + 1, F.lit(1)))
        return out.otherwise(F.when(c.rlike(r"^\p{L}$"), F.substring(F.lit("aeiou"), _pick(seed, i, 5) + 1, F.lit(1))).otherwise(c))

    return F.concat_ws("", F.transform(from_, one))


def _luhn(digits: Column) -> Column:
    """The sum that a valid card number has as a multiple of ten."""
    numbers = F.reverse(F.transform(F.split(digits, ""), lambda c: c.cast("int")))
    doubled = F.transform(numbers, lambda d, i: F.when(i % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0)))


def _drawn(seed: Column, alphabet: str, n: int) -> Column:
    """So many keyed characters."""
    return F.concat_ws("", *(F.substring(F.lit(alphabet), _pick(seed, F.lit(1000 + k), len(alphabet)) + 1, F.lit(1)) for k in range(n)))


def _word(seed: Column, word: Column, what: Column, syllables: int) -> Column:
    """A word of syllables in the script of the word of a name; a given name gets an ending of its gender."""
    table = lambda consonants, vowels: F.array(*(F.lit(c + v) for c in consonants for v in vowels))
    made = lambda consonants, vowels: F.concat_ws("", F.transform(F.sequence(F.lit(1), F.lit(syllables)), lambda k: F.element_at(table(consonants, vowels), _pick(seed, k, len(consonants) * len(vowels)) + 1)))
    ending = lambda n, a: F.when(what == "given female", n + a).when(what == "given male", n).otherwise("")
    return F.when(word.rlike(r"\p{IsCyrillic}"), F.concat(made(CYRILLIC_CONSONANTS, CYRILLIC_VOWELS), ending("н", "а"))).otherwise(F.concat(made(CONSONANTS, VOWELS), ending("n", "a")))


def secret_of(what: Column, entity: Column, key: str, turn: int) -> Column:
    """The keyed digest of an entity."""
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(str(turn)), what, entity), 256)


def surrogate(what: Column, entity: Column, secret: Column, turn: int = 0) -> Column:
    """The surrogate of an entity in its canonical form; that of a later turn is longer."""
    more, beyond = max(0, turn - 1), max(0, turn - EXTENDED + 1)
    letters, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    tail = F.length(F.regexp_extract(entity, r"\.[a-z]{2,}$", 0))
    octets = F.concat_ws(".", F.transform(F.array(*map(F.lit, range(4))), lambda i: (_pick(secret, i, 254) + 1).cast("string")))
    body = F.concat(F.substring(entity, 1, 1), _letters(secret, F.substring(entity, F.lit(2), F.length(entity) - 2)))
    check = F.pmod(10 - _luhn(F.concat(body, F.lit("0"))) % 10, F.lit(10))
    phone = F.concat_ws("", F.transform(F.split(_letters(secret, entity), ""), lambda c, i: F.when(i.isin(0, 3), (_pick(secret, i, 8) + 2).cast("string")).otherwise(c)))
    own, port, extension = _letters(secret, entity), F.lit(""), F.lit("")
    if more:
        own = F.concat(own, F.when(entity.rlike("^[0-9]+$"), _drawn(secret, digits, more)).when(entity.rlike("^[0-9a-f]+$"), _drawn(secret, "abcdef" + digits, more)).otherwise(_drawn(secret, letters, more)))
    if beyond:
        port, extension = F.concat(F.lit(":"), (_pick(secret, F.lit(2000), 64512) + 1024).cast("string")), F.concat(F.lit("x"), _drawn(secret, digits, beyond))
    return (
        F.when(what == "email", F.concat(_drawn(secret, letters, more), _letters(secret, entity, tail)))
        .when(what == "ip", F.concat(octets, port))
        .when(what == "card", F.concat(body, check.cast("int").cast("string"), extension))
        .when(what.isin("family", "given female", "given male"), _word(secret, entity, what, 4 + more))
        .when(what == "phone", F.concat(phone, extension))
        .otherwise(own)
    )


def render(mention: Column, what: Column, words: Column) -> Column:
    """The surrogates of the parts of a mention in its format."""
    made = F.concat_ws(" ", words)
    width = F.length(F.regexp_replace(mention, r"\D", ""))
    # The n-th digit from the right of the mention becomes that of the surrogate; a country code stays.
    number, extension = F.regexp_replace(made, "x.*$", ""), F.regexp_replace(F.regexp_extract(made, "x.*$", 0), "^x", " x")
    chars = F.split(mention, "")
    filled = F.concat_ws("", F.transform(chars, lambda c, i: F.when(c.rlike(r"^\d$"), _digit(mention, number, width, c, i)).otherwise(c)))
    title, name = F.regexp_extract(mention, r"^\S+ ", 0), F.regexp_replace(mention, r"^\S+ ", "")
    return (
        F.when(what == "none", mention)
        .when(what.isin("card", "phone"), F.concat(filled, extension))
        .when(what.isin("female", "male"), F.concat(title, F.when(name == F.upper(name), F.upper(made)).otherwise(F.initcap(made))))
        .when((what == "email") & (mention == F.upper(mention)), F.upper(made))
        .otherwise(made)
    )


def _digit(mention: Column, made: Column, width: Column, c: Column, i: Column) -> Column:
    before = F.length(F.regexp_replace(F.substring(mention, F.lit(1), i), r"\D", ""))
    at = before + 1 - (width - F.length(made))
    return F.when(at >= 1, F.substring(made, at, F.lit(1))).otherwise(c)


def _made(entities: DataFrame, key: str, turn: int) -> DataFrame:
    keyed = entities.select("what", "entity", secret_of(F.col("what"), F.col("entity"), key, turn).alias("secret"))
    return materialise(keyed.select("what", "entity", surrogate(F.col("what"), F.col("entity"), F.col("secret"), turn).alias("made")), "entities")


def _exceptions(entities: DataFrame, key: str) -> DataFrame | None:
    """what, entity and made of the entities whose first surrogate is not theirs alone; None without any."""
    known = _made(entities, key, 0)
    mixed = lambda df, taken: df.join(taken, ["what", "made"])
    real = known.select("what", F.col("entity").alias("made"))

    def clashing(made: DataFrame) -> DataFrame:
        """Entities that must take another turn: not the first of their surrogate, or a surrogate that is an entity."""
        shared = made.groupBy("what", "made").agg(F.count(F.lit(1)).alias("n"), F.min("entity").alias("first")).filter("n > 1")
        later = mixed(made, shared).filter("entity <> first").select("what", "entity")
        return later.unionByName(mixed(made, real).select("what", "entity")).distinct()

    open_ = materialise(clashing(known), "clashing")
    settled, turn = None, 0
    taken = known.select("what", "made")
    while not open_.isEmpty():
        turn += 1
        tried = _made(open_, key, turn)
        bad = clashing(tried).unionByName(mixed(tried, taken).select("what", "entity")).distinct()
        bad = materialise(bad, "clashing")
        good = tried.join(bad, ["what", "entity"], "left_anti")
        settled = good if settled is None else settled.unionByName(good)
        taken, open_ = taken.unionByName(good.select("what", "made")), bad
    return settled


def replace(docs: DataFrame, key: str) -> DataFrame:
    """docs with surrogates in the column text, and the number of replaced mentions in a last column.

    All other columns stay; the last one is ``n_replaced`` (with underscores where there is one already).
    NULL texts stay NULL with 0 mentions, empty texts stay empty; repeated rows
    are treated alike; texts of any length are read whole, in one row. An empty table gives no rows.
    docs must give the same rows in the same order on each read, as stored tables do.
    """
    row, found, made, pieces, name = fresh(docs, "row_number_of_text", "mentions", "exceptions_of_text", "pieces_of_text", "n_replaced")
    text = F.col("text").cast("string")
    hinted = text.rlike(HINT)
    marked = docs.select(
        "*", F.monotonically_increasing_id().alias(row), F.when(hinted, F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))).otherwise(F.array().cast("array<string>")).alias(found),
        F.when(hinted, F.split(text, ENTITY, -1)).alias(pieces),
    )
    # Each step names what the next ones need, so that no expression is written out twice.
    typed = F.transform(F.col(found), lambda m, i: F.struct(m.alias("mention"), kind(m, F.get(pieces, i)).alias("what")))
    split = F.transform(typed, lambda m: F.struct(m.mention.alias("mention"), m.what.alias("what"), parts(m.mention, m.what).alias("parts")))
    # The place of a part in its text: at most two to a mention.
    placed = F.transform(split, lambda m, i: F.struct(m.mention.alias("mention"), m.what.alias("what"), F.transform(m.parts, lambda p, k: F.struct(p.what.alias("what"), p.entity.alias("entity"), (2 * i + k).cast("int").alias("at"))).alias("parts")))
    marked = marked.withColumn(found, placed)
    mentions = marked.select(row, F.explode(F.flatten(F.transform(found, lambda m: m.parts))).alias("p")).select(row, "p.*")
    exceptions = _exceptions(mentions.select("what", "entity").distinct(), key)
    if exceptions is None:
        marked = marked.withColumn(made, F.lit(None).cast("map<int,string>"))
    else:
        hit = mentions.join(exceptions, ["what", "entity"]).groupBy(row).agg(F.map_from_entries(F.collect_list(F.struct("at", "made"))).alias(made))
        marked = marked.join(hit, row, "left")

    def keyed(p: Column) -> Column:
        return F.struct(p.what.alias("what"), p.entity.alias("entity"), secret_of(p.what, p.entity, key, 0).alias("secret"), F.try_element_at(F.col(made), p["at"]).alias("other"))

    def change(m: Column) -> Column:
        words = F.transform(F.transform(m.parts, keyed), lambda p: F.coalesce(p.other, surrogate(p.what, p.entity, p.secret)))
        return F.struct(m.mention.alias("mention"), m.what.alias("what"), words.alias("words"))

    changed = F.transform(F.transform(F.col(found), change), lambda m: render(m.mention, m.what, m.words))
    joined = F.concat_ws("", F.flatten(F.zip_with(F.col(pieces), changed, lambda p, c: F.array(p, F.coalesce(c, F.lit(""))))))
    replaced = F.size(F.filter(found, lambda m: m.what != "none"))
    new = F.when(F.size(found) > 0, joined).otherwise(text)
    return marked.select(*[new.alias("text") if c == "text" else F.col(c) for c in docs.columns], replaced.cast("long").alias(name))
