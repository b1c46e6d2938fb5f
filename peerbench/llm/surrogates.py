"""Replacement of personal data by keyed surrogates of the same type and format.

Detected: e-mail addresses, secrets (after password, token, key ... or of a well-known form), card numbers (with a right
check digit), phone and social security numbers, IBANs, birth dates (after born, DOB ...), IPv4 and IPv6 addresses, and
names. A name is recognised after a title; from then on every capitalised mention of one of its parts counts in the whole
document, with or without title, also in the possessive. Names without any title in their document are not found.

An entity is a type and a core: digits without their separators, an address in lower case, each part of a name by itself.
Its surrogate is a function of key, type, core and attempt, so the same entity has the same surrogate in every document
and notation (coreference). Surrogates keep length, separators, character classes, country prefix, Luhn and IBAN check
digits, private address ranges, the top-level domain, and for names the script, the case and the gender. Gender is no
part of the identity: it follows from all titles of the corpus that stand before the given name, and where they
disagree or say nothing, the surrogate is of neither gender.

All distinct entities of the corpus are checked for collisions: where two of a type would share a surrogate, the
smaller core keeps it, and where a surrogate is itself an entity of the corpus, it is given up; the rest try the next
attempt until none collide. From the ninth attempt on surrogates become longer (names, e-mail addresses, secrets, phone
numbers, shortened IPv6 addresses), leave their narrow private range for the widest one and that one for the public one, or take any year (birth
dates), so that a type with few surrogates in its usual form does not run out. The table of entities is shuffled by type
and surrogate; nothing of it is collected.

Everything is DataFrame functions. Documents without a digit, an @ or a title are passed by; what is found in the others
is stored once, and only those with entities are shuffled, to meet their surrogates. The key is the caller's: who has
it can compute surrogates, so it belongs to the settings of a run and not to the code.

Defined results: a null text stays null; rows that share doc_id and text are one document; a null doc_id is an id of its
own; further columns are untouched; a full and a shortened IPv6 address are two entities.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count as numbers

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from peerbench.llm.frames import stored, table, text_key
from peerbench.llm.linededup import let

#: The setting of the session that holds the key of ``op9_surrogates``; without it, its results are good for tests only.
KEY_SETTING = "spark.peerbench.surrogateKey"
#: Attempts in the usual form of a type.
USUAL = 8

_MALE = ("Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "г-н", "господин")
_FEMALE = ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Señora", "Sra", "г-жа", "госпожа")
_NEUTRAL = ("Dr", "Prof")
_TITLES = "|".join(sorted(_MALE + _FEMALE + _NEUTRAL, key=len, reverse=True))
_PART = r"\p{Lu}\p{L}*['’-]?\p{L}+(?:['’-]\p{L}+)*"

_EMAIL = r"[\p{L}0-9._%+-]{1,64}@(?:[\p{L}0-9-]{1,63}\.){1,8}[\p{L}]{2,24}"
_LABELLED = r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|bearer)\b\"?[ ]?[=: ][ ]?[\"']?)[A-Za-z0-9+/_.=-]*[0-9][A-Za-z0-9+/_.=-]{4,}"
_KNOWN = r"\b(?:AKIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9]{20,})\b"
_IP = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]*\d)"
_SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]*\d)"
_CARD = r"(?<![\d+])(?:\d[ -]?){12,18}\d(?!\d)"
_PHONE = r"(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|(?<!\d)\d{3}[.-])\d{3}[ .-]\d{4}(?!\d)|\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)"
_IBAN = r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"
_DATE_LABEL = r"(?i:\b(?:born|birthday|birth date|date of birth|d\.?o\.?b\.?|geboren|geb\.|née?|nacid[oa])(?: on| am| le| el)?:? )"
_DATE = r"(?:\d{4}[-/.]\d{1,2}[-/.]\d{1,2}|\d{1,2}[-/.]\d{1,2}[-/.]\d{4})\b"
_BIRTH = _DATE_LABEL + _DATE
_IP6 = r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:])"
_NAME = rf"(?<![\p{{L}}])(?:{_TITLES})\.? {_PART}(?: {_PART})?"
_ALL = "|".join((_EMAIL, _LABELLED, _KNOWN, _BIRTH, _IP6, _IP, _IBAN, _SSN, _PHONE, _CARD, _NAME))
#: Every entity holds one of these.
_HINT = rf"[0-9@]|:[0-9A-Fa-f]*:|(?:{_TITLES})\.? \p{{Lu}}"

_SYLLABLES = {
    "latin": "ba be bo da de do fa fe ka ke ko la le lo ma me mo na ne no ra re ri ro sa se so ta te ti to".split(),
    "cyrillic": "ба бе бо да де до ка ке ко ла ле ло ма ме мо на не но ра ре ри ро са се со та те ти то ва ве".split(),
}
_ENDINGS = {
    ("latin", "m"): ["n", "rd", "ck", "s"], ("latin", "f"): ["na", "lia", "ra", "sa"], ("latin", "n"): ["ly", "ne", "sh", "m"],
    ("cyrillic", "m"): ["н", "рд", "к", "с"], ("cyrillic", "f"): ["на", "лина", "ра", "са"], ("cyrillic", "n"): ["ли", "не", "ш", "м"],
}


def _parsed(match: Column) -> Column:
    """struct(prefix, pieces of (kind, raw, core, gender)) of one match; a match that is no entity is all prefix."""
    piece = lambda kind, raw, core, gender: F.struct(kind.alias("kind"), raw.alias("raw"), core.alias("core"), gender.cast("string").alias("gender"))
    one = lambda kind, raw, core: F.array(piece(F.lit(kind), raw, core, F.lit(None)))
    whole = lambda kind, core: F.struct(F.lit("").alias("prefix"), one(kind, match, core).alias("pieces"))
    digits = F.regexp_replace(match, r"[^0-9]", "")
    like = lambda pattern: match.rlike(rf"^(?:{pattern})$")
    label = F.regexp_extract(match, r"^(?i:(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|bearer)\"?[ ]?[=: ][ ]?[\"']?)", 0)
    secret = F.substring(match, F.length(label) + 1, F.length(match))
    title = F.regexp_extract(match, rf"^(?:{_TITLES})\.? ", 0)
    bare = F.regexp_replace(title, r"\.? $", "")
    gender = F.when(bare.isin(*_MALE), "m").when(bare.isin(*_FEMALE), "f")
    names = F.split(F.substring(match, F.length(title) + 1, F.length(match)), " ")

    birth = F.regexp_extract(match, rf"^{_DATE_LABEL}", 0)
    date = F.substring(match, F.length(birth) + 1, F.length(match))
    nothing = F.struct(match.alias("prefix"), F.filter(one("card", match, match), lambda p: F.lit(False)).alias("pieces"))

    def part(name: Column, i: Column) -> Column:
        # a family name has no gender of its own
        return piece(_name_kind(name), name, _name_core(name), F.when(i < F.size(names) - 1, gender))

    return (
        F.when(title != "", F.struct(title.alias("prefix"), F.transform(names, part).alias("pieces")))
        .when(label != "", F.struct(label.alias("prefix"), one("secret", secret, secret).alias("pieces")))
        .when(match.contains("@"), whole("email", F.lower(match)))
        .when(like(_KNOWN), whole("secret", match))
        .when(birth != "", F.struct(birth.alias("prefix"), one("birth", date, date).alias("pieces")))
        .when(like(_IP6), whole("ip6", F.lower(match)))
        .when(like(_IP), whole("ip", match))
        .when(like(_IBAN), whole("iban", F.replace(match, F.lit(" "), F.lit(""))))
        .when(like(_SSN), whole("ssn", digits))
        .when(like(_PHONE), whole("phone", digits))
        .when(_luhn(digits) == 0, whole("card", digits))
        .otherwise(nothing)
    )


def _name_kind(name: Column) -> Column:
    return F.concat(F.lit("name:"), F.when(name.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin"))


def _name_core(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), "['’]s$", "")


def _draws(kind: Column, core: Column, attempt: Column, key: str, count: int | Column) -> Column:
    """Array of ``count`` keyed numbers below 2 ** 16."""
    parts = F.sequence(F.lit(0), F.ceil(count / F.lit(16.0)).cast("int") if isinstance(count, Column) else F.lit(-(-count // 16)))
    seed = F.concat_ws("|", kind, core, attempt.cast("string"))
    # keyed inside and outside, so that no hash can be prolonged without the key
    hashed = lambda i: F.sha2(F.concat_ws("|", F.lit(key), F.sha2(F.concat_ws("|", F.lit(key), seed, i.cast("string")), 256)), 256)
    stream = F.array_join(F.transform(parts, hashed), "")
    return let(stream, lambda s: F.transform(F.sequence(F.lit(0), (count if isinstance(count, Column) else F.lit(count)) - 1), lambda i: F.conv(F.substr(s, i * 4 + 1, F.lit(4)), 16, 10).cast("int")))


def _letters(core: Column, draws: Column, fixed: Column | None = None) -> Column:
    """``core`` with every character replaced within its class; from position ``fixed`` on it stays."""
    pick = lambda alphabet, n: F.substr(F.lit(alphabet), n % len(alphabet) + 1, F.lit(1))
    hexadecimal = core.rlike("^[0-9]*[a-f][0-9a-f]*$")

    def swap(i: Column) -> Column:
        char, n = F.substr(core, i + 1, F.lit(1)), F.get(draws, i)
        new = (
            F.when(hexadecimal, pick("0123456789abcdef", n))
            .when(char.rlike("[0-9]"), pick("0123456789", n)).when(char.rlike("[A-Z]"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", n))
            .when(char.rlike("[a-z]"), pick("abcdefghijklmnopqrstuvwxyz", n)).when(char.rlike(r"\p{IsCyrillic}"), pick("абвгдежзиклмнопрстуфхцчшэюя", n))
            .when(char.rlike(r"\p{Ll}"), pick("àáâãäåæçèéêëìíîïñòóôõöøùúûü", n)).otherwise(char)
        )
        return new if fixed is None else F.when(i >= fixed, char).otherwise(new)

    return F.array_join(F.transform(F.sequence(F.lit(0), F.length(core) - 1), swap), "")


def _luhn(digits: Column) -> Column:
    """Luhn sum modulo 10 of a digit string."""
    size = F.length(digits)
    value = lambda i: F.substr(digits, i, F.lit(1)).cast("int")
    step = lambda i: F.when((size - i) % 2 == 1, (value(i) * 2) % 10 + F.floor(value(i) / 5).cast("int")).otherwise(value(i))
    return F.aggregate(F.transform(F.sequence(F.lit(1), size), step), F.lit(0), lambda a, b: a + b) % 10


def _rest97(text: Column) -> Column:
    """Remainder by 97 of the number of an IBAN whose first four characters have been put last."""
    value = lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    step = lambda a, c: (a * F.when(c.rlike("[0-9]"), 10).otherwise(100) + value(c)) % 97
    return F.aggregate(F.split(F.concat(F.substr(text, F.lit(5)), F.substr(text, F.lit(1), F.lit(4))), ""), F.lit(0), step)


def surrogate(kind: Column, core: Column, attempt: Column, key: str) -> Column:
    """The surrogate of an entity at an attempt, in the form of its core."""
    more = F.greatest(F.lit(0), attempt - USUAL)
    longer = F.ceil(more / F.lit(4.0)).cast("int")
    own = core
    core = (
        F.when(kind == "email", F.concat(F.repeat(F.lit("a"), longer), core)).when(kind == "phone", F.concat(core, F.repeat(F.lit("0"), longer)))
        .when(kind == "secret", F.concat(core, F.repeat(F.lit("0"), longer))).otherwise(core))
    draws = lambda count: _draws(kind, own, attempt, key, count)
    digit = lambda n: (n % 10).cast("string")
    every = draws(F.length(core))

    def phone(d: Column) -> Column:
        start = F.greatest(F.lit(0), F.length(own) - 10)  # country prefix
        new = lambda i: F.when(i < start, F.substr(core, i + 1, F.lit(1))).when((i == start) | (i == start + 3), (F.get(d, i) % 8 + 2).cast("string")).otherwise(digit(F.get(d, i)))
        return F.array_join(F.transform(F.sequence(F.lit(0), F.length(core) - 1), new), "")

    def card(d: Column) -> Column:
        body = F.concat(F.substr(core, F.lit(1), F.lit(1)), F.array_join(F.transform(F.slice(d, 2, F.length(core) - 2), digit), ""))
        good = let(body, lambda b: F.concat(b, ((10 - _luhn(F.concat(b, F.lit("0")))) % 10).cast("string")))
        return F.when(_luhn(core) == 0, good).otherwise(F.concat(body, digit(F.get(d, F.length(core) - 1))))

    def address(d: Column) -> Column:
        octets = F.split(core, r"\.")
        host = lambda i: (F.get(d, F.lit(i)) % 254 + 1).cast("string")
        narrow = core.rlike(r"^192\.168\.|^169\.254\.") & (more == 0)
        private = core.rlike(r"^(10|127)\.|^192\.168\.|^169\.254\.") & (more <= USUAL)
        public = (F.get(d, F.lit(0)) % 115 + 11).cast("string")
        first = F.when(narrow, octets[0]).when(private & core.startswith("127."), F.lit("127")).when(private, F.lit("10")).otherwise(public)
        return F.concat_ws(".", first, F.when(narrow, octets[1]).otherwise(host(1)), host(2), host(3))

    def address6(d: Column) -> Column:
        hexadecimal = lambda n, low: F.substr(F.lit("0123456789abcdef"), n % (16 - low) + low + 1, F.lit(1))
        start = F.regexp_extract(core, "^(?:fe80|f[cd][0-9a-f]{2}|2001|2002):", 0)
        # a shortened address has few others of its form, so it is written in full later on
        full = F.concat(F.when(start == "", "0000:").otherwise(start), F.lit(":".join(["0000"] * 7)))
        form = F.when(more == 0, core).otherwise(full)

        def swap(i: Column) -> Column:
            char, first = F.substr(form, i + 1, F.lit(1)), (i == 0) | (F.substr(form, i, F.lit(1)) == ":")
            n = F.get(d, i)
            return F.when((char == ":") | (i < F.length(start)), char).when(first, hexadecimal(n, 1)).otherwise(hexadecimal(n, 0))

        return F.array_join(F.transform(F.sequence(F.lit(0), F.length(form) - 1), swap), "")

    def iban(d: Column) -> Column:
        body = F.substr(_letters(core, d), F.lit(5))
        country = F.substr(core, F.lit(1), F.lit(2))
        check = F.lpad((98 - _rest97(F.concat(country, F.lit("00"), body))).cast("string"), 2, "0")
        return F.concat(country, F.when(_rest97(core) == 1, check).otherwise(F.substr(_letters(core, d), F.lit(3), F.lit(2))), body)

    def birth(d: Column) -> Column:
        # day and month are both a number below 13, so that the date is one in either order
        year = F.when(more > 0, F.get(d, F.lit(0)) % 9000 + 1000).otherwise(F.get(d, F.lit(0)) % 80 + 1930).cast("string")
        numbers_of = F.regexp_extract_all(core, F.lit(r"\d+"), F.lit(0))
        signs = F.regexp_extract_all(core, F.lit(r"\D"), F.lit(0))
        new = F.transform(numbers_of, lambda x, i: F.when(F.length(x) == 4, year).otherwise(F.lpad((F.get(d, i + 1) % 12 + 1).cast("string"), 2, "0")))
        return F.concat(F.get(new, F.lit(0)), F.get(signs, F.lit(0)), F.get(new, F.lit(1)), F.get(signs, F.lit(1)), F.get(new, F.lit(2)))


    def email(d: Column) -> Column:
        return _letters(core, d, F.length(core) - F.length(F.regexp_extract(core, r"\.\p{L}+$", 0)))

    def name(d: Column) -> Column:
        made = F.lit(None).cast("string")
        for (script, gender), endings in _ENDINGS.items():
            syllables = F.array(*[F.lit(s) for s in _SYLLABLES[script]])
            # later attempts have more syllables, so there is no end of names
            body = F.array_join(F.transform(F.sequence(F.lit(0), 1 + F.least(attempt, F.lit(28))), lambda i: F.get(syllables, F.get(d, i) % len(_SYLLABLES[script]))), "")
            ending = F.get(F.array(*[F.lit(e) for e in endings]), F.get(d, F.lit(31)) % len(endings))
            made = F.when(kind == f"name:{script}:{gender}", F.concat(body, ending)).otherwise(made)
        return made

    return (
        F.when(kind == "email", let(every, email)).when(kind == "secret", let(every, lambda d: _letters(core, d)))
        .when(kind == "phone", let(every, phone)).when(kind == "card", let(every, card)).when(kind == "ip", let(draws(4), address))
        .when(kind == "ip6", let(draws(39), address6)).when(kind == "iban", let(every, iban)).when(kind == "birth", let(draws(4), birth))
        .when(kind == "ssn", let(every, lambda d: _letters(core, d))).otherwise(let(draws(32), name))
    )


def _fitted(raw: Column, kind: Column, value: Column) -> Column:
    """A surrogate in the notation of ``raw``."""

    def spaced(sign: str) -> Column:
        """The characters of ``raw`` that are a sign replaced in order; what is left of the surrogate follows."""
        before = lambda i: F.length(F.regexp_replace(F.substr(raw, F.lit(1), i), f"[^{sign}]", ""))
        char = lambda i: F.substr(raw, i, F.lit(1))
        new = F.transform(F.sequence(F.lit(1), F.length(raw)), lambda i: F.when(char(i).rlike(f"[{sign}]"), F.substr(value, before(i), F.lit(1))).otherwise(char(i)))
        return F.concat(F.array_join(new, ""), F.substr(value, before(F.length(raw)) + 1))

    tail = F.regexp_extract(raw, "['’][sS]$", 0)
    body = F.substr(raw, F.lit(1), F.length(raw) - F.length(tail))
    cased = F.when((body == F.upper(body)) & (F.length(body) > 1), F.upper(value)).when(F.substr(raw, F.lit(1), F.lit(1)) == F.upper(F.substr(raw, F.lit(1), F.lit(1))), F.initcap(value)).otherwise(value)
    upper = (raw == F.upper(raw)) & (raw != F.lower(raw))
    return (
        F.when(kind.isin("phone", "card", "ssn"), spaced("0-9")).when(kind == "iban", spaced("A-Z0-9")).when(kind.isin("ip", "secret", "birth"), value)
        .when(kind.isin("email", "ip6"), F.when(upper, F.upper(value)).otherwise(value)).otherwise(F.concat(cased, tail))
    )


def assign_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, core, surrogate) of the distinct entities (kind, core).

    The kind of a name may end in its gender (``:m``, ``:f``, ``:n``). Surrogates of a kind, whatever the gender, differ
    from each other and from all its cores.
    """
    made = lambda attempt: surrogate(F.col("kind"), F.col("core"), attempt, key)
    space = F.regexp_replace("kind", ":[mfn]$", "").alias("space")
    state = entities.distinct().withColumn("attempt", F.lit(0)).withColumn("settled", F.lit(False))
    state = stored(state.withColumn("surrogate", made(F.col("attempt"))), "entities")
    for _ in numbers():  # spaces grow with the attempts, so some round is the last
        real = entities.select(space, F.col("core").alias("surrogate"), F.lit(True).alias("real")).distinct()
        place = F.row_number().over(W.partitionBy("space", "surrogate").orderBy(F.col("settled").desc(), "core", "kind"))
        judged = state.select("*", space).join(real, ["space", "surrogate"], "left").withColumn("ok", (place == 1) & F.col("real").isNull())
        attempt = F.when(F.col("ok"), F.col("attempt")).otherwise(F.col("attempt") + 1)
        judged = stored(judged.select("kind", "core", attempt.alias("attempt"), F.col("ok").alias("settled"), F.col("surrogate").alias("old")), "judged")
        again = made(F.col("attempt"))
        state = judged.withColumn("surrogate", F.when(F.col("settled"), F.col("old")).otherwise(again)).drop("old")
        if judged.where("not settled").isEmpty():
            break
        state = stored(state, "entities")
    return state.select("kind", "core", "surrogate")


def replace_private(docs: DataFrame, key: str, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Per document row: ``doc`` (the columns named in ``keep``), text (with surrogates), n_entities (mentions replaced)."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc"), F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"))
    hinted = F.coalesce(F.col("text").rlike(_HINT), F.lit(False))
    plain = rows.where(~hinted).select("doc", "text", F.lit(0).cast("long").alias("n_entities"))
    # the text between matches and what was found, written once: the patterns are the dear part
    matches = F.regexp_extract_all("text", F.lit(_ALL), F.lit(0))
    touched = stored(rows.where(hinted).select("doc", "id", text_key().alias("tk"), F.split("text", _ALL, -1).alias("gaps"), F.transform(matches, _parsed).alias("found")), "found")
    pieces = stored(touched.select("id", "tk", F.explode(F.flatten("found.pieces")).alias("p")).select("id", "tk", "p.kind", "p.core", "p.gender").distinct(), "pieces")
    sexes = pieces.groupBy("kind", "core").agg(F.min("gender").alias("low"), F.max("gender").alias("high"))
    gender = F.when(F.col("kind").startswith("name:"), F.when(F.col("low") == F.col("high"), F.concat(F.lit(":"), "low")).otherwise(":n")).otherwise("")
    known = stored(sexes.select(F.concat("kind", gender).alias("kind"), "core"), "known")
    named = assign_surrogates(known, key).select(F.regexp_replace("kind", ":[mfn]$", "").alias("kind"), "core", "surrogate")
    entry = F.struct(F.concat_ws("|", "kind", "core"), "surrogate")
    per = pieces.select("id", "tk", "kind", "core").distinct().join(stored(named, "surrogates"), ["kind", "core"]).groupBy(F.col("id").alias("its_id"), F.col("tk").alias("its_tk")).agg(
        F.map_from_entries(F.collect_list(entry)).alias("of"), F.max(F.col("kind").startswith("name:")).alias("has_names"))
    met = touched.join(per, F.col("id").eqNullSafe(F.col("its_id")) & (F.col("tk") == F.col("its_tk")), "left")

    def of(kind: Column, core: Column) -> Column:
        return F.try_element_at("of", F.concat_ws("|", kind, core))

    def mentions(gap: Column) -> Column:
        """Words and what stands between them, with the surrogate of each word that is a name of the document."""
        tokens = F.regexp_extract_all(gap, F.lit(r"\p{L}+(?:['’-]\p{L}+)*|[^\p{L}]+"), F.lit(0))
        return F.transform(tokens, lambda t: F.struct(t.alias("raw"), F.when(t.rlike(r"^\p{Lu}"), of(_name_kind(t), _name_core(t))).alias("new")))

    renew = lambda m: F.concat(m["prefix"], F.array_join(F.transform(m["pieces"], lambda p: _fitted(p["raw"], p["kind"], of(p["kind"], p["core"]))), " "))
    again = F.flatten(F.transform("gaps", mentions))
    word = lambda t: F.when(t["new"].isNull(), t["raw"]).otherwise(_fitted(t["raw"], F.lit("name"), t["new"]))
    between = F.when(F.col("has_names"), F.transform("gaps", lambda g: F.array_join(F.transform(mentions(g), word), ""))).otherwise(F.col("gaps"))
    count = F.size(F.filter("found", lambda m: F.size(m["pieces"]) > 0)) + F.when(F.col("has_names"), F.size(F.filter(again, lambda t: t["new"].isNotNull()))).otherwise(0)
    joined = let(F.struct(between.alias("gaps"), F.transform("found", renew).alias("new")), lambda x: F.array_join(F.transform(x["gaps"], lambda g, i: F.concat(g, F.coalesce(F.get(x["new"], i), F.lit("")))), ""))
    changed = met.select("doc", joined.alias("text"), count.cast("long").alias("n_entities"))
    return plain.unionByName(changed)


def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates for personal data."""
    key = spark.conf.get(KEY_SETTING, "key for tests")
    done = replace_private(table(spark, sf_dir, "documents"), key)
    return done.select("doc.doc_id", "n_entities", "text")
