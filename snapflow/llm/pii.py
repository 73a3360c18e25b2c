"""Personal data and secrets replaced by keyed surrogates; DataFrame functions only.

Detected are e-mail addresses, phone numbers, IPv4 and IPv6 addresses, payment cards (first digits of an issuer, valid
check digit), bank accounts (IBAN, valid check number), US social security numbers, cloud and repository access keys,
hexadecimal secrets, values after a password-like word (with a digit; without one from 8 characters if they change from
lower to upper case or hold a symbol, else from 16), and persons named after a form of address or a doctor's title (then
also their bare names in the same text). Everything is compared in a normal form (digits of numbers, lower case of
addresses, each name by itself), so other spellings of one thing get one surrogate, in all texts.

A surrogate is a keyed hash written in the form of what it replaces: same length, separators and classes of characters,
country code, key prefix, check digits, script of a name, and a name's gender by its form of address (a title without
gender: a name of either). Surrogates are checked against each other and against all detected originals of their kind: of
several originals with one candidate the least keeps it, the others try again with the next attempt's hash, from the 16th
attempt with one character more at each: room grows tenfold an attempt, so any number of originals comes to an end.
So different originals always get different surrogates, and no surrogate is an original.

Texts that hold nothing stay as they are (null stays null). Equal texts are worked on once. Values join their surrogates
by an ordinary join, whose one side has one row a value: a value in a third of all texts is a hot key of the other side
alone, which adaptive execution splits.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapflow.session import reliable_checkpoint

#: Attempts in the form of the original; each later one adds a character.
PLAIN_ATTEMPTS = 16

# Detection patterns and forms of address. Fixed values.
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_LETTER = r"\u00C0-\u024F\u0370-\u1FFF"
EMAIL = (rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}+@(?:[A-Za-z0-9{_LETTER}-]{{1,63}}\.){{1,8}}"
         rf"(?:[A-Za-z]{{2,24}}|[{_LETTER}]{{2,24}})(?![A-Za-z0-9-])")
IPV4 = rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?[0-9])"
_GROUP = "[0-9A-Fa-f]{1,4}"
IPV6 = (rf"(?<![0-9A-Za-z:])(?=[A-Fa-f:]*[0-9])(?:(?:{_GROUP}:){{7}}{_GROUP}|(?:{_GROUP}:){{1,6}}(?::{_GROUP}){{1,6}})"
        r"(?![0-9A-Za-z:])")
KEY = r"(?<![A-Za-z0-9])(?:A(?:KIA|SIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}+)(?![A-Za-z0-9])"
_KEY_PREFIX = "^(?:A(?:KIA|SIA)|gh[pousr]_)"
IBAN = (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}| [A-Z0-9]{4}(?: (?=[A-Z]{0,3}[0-9])[A-Z0-9]{4}){1,6}"
        r"(?: (?=[A-Z]{0,2}[0-9])[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
SSN = r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])"
CARD = (r"(?<![A-Za-z0-9])(?:(?:4[0-9]{3}|5[0-8][0-9]{2}|2[2-7][0-9]{2}|35[0-9]{2}|6(?:011|2[0-9]{2}|4[4-9][0-9]|5[0-9]{2}))"
        r"(?:[ -]?[0-9]{4}){3}|3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5})(?![A-Za-z0-9])")
PHONE = (r"(?<![A-Za-z0-9+])(?:(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
         r"|\+[0-9]{1,3}(?:[ .-][0-9]{2,4}){2,5}|\+[1-9][0-9]{0,2}[ .-]?[0-9]{6,12})(?![A-Za-z0-9])")
HEX = r"(?<![A-Za-z0-9])[0-9a-f]{32,}+(?![A-Za-z0-9])"
_WORDS = r"(?i:password|passwd|pwd|secret|api_?key|access_?token|token)"
SECRET = (rf"(?<![A-Za-z0-9_]){_WORDS}[\"']?[ ]?[=:][ ]?[\"']?"
          r"(?:(?=[^\s\"',;]*[0-9])|(?=[^\s\"',;]{16})|(?=[^\s\"',;]{8})(?=[^\s\"',;]*(?:[a-z][A-Z]|[!@#$%^&*+~])))[^\s\"',;]{4,}+")
_SECRET_PREFIX = rf"^{_WORDS}[\"']?[ ]?[=:][ ]?[\"']?"
MALE = ["Mister", "Mr", "Herr", "Monsieur", "Señor", "Sr", "господин", "г-н", "κύριος", "Κύριος"]
FEMALE = ["Mrs", "Miss", "Ms", "Frau", "Madame", "Mme", "Señora", "Sra", "госпожа", "г-жа", "κυρία", "Κυρία"]
NEUTRAL = ["Dr", "Prof", "Professor", "д-р", "Δρ"]
_NAME = r"\p{Lu}[\p{L}'’-]{0,40}\p{L}"
PERSON = rf"(?<![\p{{L}}\p{{N}}])((?:{'|'.join(sorted(MALE + FEMALE + NEUTRAL, key=len, reverse=True))})\.?[  ])({_NAME})(?: ({_NAME}))?"
NUMBERED = "|".join([SECRET, EMAIL, IPV4, IPV6, KEY, IBAN, SSN, CARD, PHONE, HEX])
#: What every text with a match of ``NUMBERED`` holds.
_MARK = "[0-9@]|(?i:passw|pwd|secret|key|token)"
BASE = f"{NUMBERED}|{PERSON}"

# Syllables that names are built of, by script: first, middle, last of given names (male, female) and of family names
# (male, female), and for Latin of given names of either gender.
# Fixed values.
_SYLLABLES = {
    "Latin": ("Al Be Ca Da El Fa Ga He Jo Ka Le Ma Ni Ro Sa Ta".split(), "la ri ne do mi va re lo na ti be ra ni so ve da".split(),
              "o an us er en is in ard".split(), "a ia ine elle ina ette is ora".split(), "ner mann son ley ez eau ini well".split(),
              "ner mann son ley ez eau ini well".split(), "is en ar ey lin ian".split()),
    "Cyrillic": ("Ал Бе Ва Да Ели Га Ми Ни Ро Са Та Ма Ла Ка Ве Се".split(), "ла ри не до ми ва ре ло на ти бе ра ни со ве да".split(),
                 "н р й л с к м т".split(), "на ра я ла са ка ма та".split(), "нов ров лин ков тин сов мин бов".split(),
                 "нова рова лина кова тина сова мина бова".split()),
    "Greek": ("Αλ Βα Γε Δη Ελ Ζω Θε Κα Λε Μα Νι Πα Ρο Σα Τα Φι".split(), "λα ρι νε δο μι βα ρε λο να τι βε ρα νι σο βε δα".split(),
              "ος ης ας ων ιος ις ευς ανος".split(), "α η ω ια ιδα ουλα ινα ανη".split(), "ιδης ακης οπουλος ατος εας ινος ελης ανος".split(),
              "ιδου ακη οπουλου ατου εα ινου ελη ανου".split()),
}


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, not again for each element of a ``transform`` in it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _extra(attempt: int) -> int:
    """Characters that an attempt adds."""
    return max(0, attempt - PLAIN_ATTEMPTS + 1)


def _bytes(key: str, kind: Column, norm: Column, attempt: int) -> Column:
    """A stream of hash bytes for a value, in hexadecimal blocks of 64: one byte a character, added ones too, and some to spare."""
    seed = F.concat_ws("\x1f", F.lit(key), kind, norm, F.lit(str(attempt)))
    seed = F.when(F.length(norm) > 128, F.sha2(seed, 512)).otherwise(seed)     # a long value is hashed once, not by block
    blocks = F.sequence(F.lit(0), F.floor((F.length(norm) + 16 + _extra(attempt)) / 64).cast("int"))
    return _once(seed, lambda x: F.transform(blocks, lambda j: F.sha2(F.concat(x, F.lit("\x1f"), j.cast("string")), 512)))


def _byte(stream: Column, i: Column) -> Column:
    block = F.element_at(stream, F.floor(i / 64).cast("int") + 1)
    return F.conv(F.substring(block, (i % 64) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(letters: str, b: Column) -> Column:
    return F.substring(F.lit(letters), b % len(letters) + 1, F.lit(1))


def _like(token: Column, stream: Column, digits: str = "0123456789") -> Column:
    """Other characters of the same classes; what is neither digit nor Latin letter stays."""
    def one(c: Column, i: Column) -> Column:
        b = _byte(stream, i)
        return (F.when(c.rlike("[0-9]"), _pick(digits, b)).when(c.rlike("[a-z]"), _pick("abcdefghijklmnopqrstuvwxyz", b))
                .when(c.rlike("[A-Z]"), _pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", b)).otherwise(c))
    return F.array_join(F.transform(F.split(token, ""), one), "")


def luhn(digits: Column) -> Column:
    """The check sum (0 if valid) of a string of digits whose last one is the check digit."""
    n = F.length(digits)

    def one(c: Column, i: Column) -> Column:
        v = c.cast("int") * (((n - 1 - i) % 2) + 1)
        return F.when(v > 9, v - 9).otherwise(v)
    return F.aggregate(F.transform(F.split(digits, ""), one), F.lit(0), lambda a, x: a + x) % 10


def iban_rest(v: Column) -> Column:
    """The check number (1 if valid) of a bank account number without blanks."""
    moved = F.split(F.concat(F.substring(v, F.lit(5), F.length(v)), F.left(v, F.lit(4))), "")
    return F.aggregate(F.transform(moved, lambda c: F.conv(c, 36, 10).cast("int")), F.lit(0),
                       lambda a, x: (a * F.when(x > 9, 100).otherwise(10) + x) % 97)


def _name(script: str, end: int, stream: Column, attempt: int) -> Column:
    first, middle = _SYLLABLES[script][:2]
    last = _SYLLABLES[script][end]

    def choose(items: list[str], i: int) -> Column:
        b = _byte(stream, F.lit(2 * i)) * 256 + _byte(stream, F.lit(2 * i + 1))
        return F.element_at(F.array(*map(F.lit, items)), (b % len(items) + 1).cast("int"))
    return F.concat(choose(first, 0), *(choose(middle, 2 + i) for i in range(min(1 + attempt // 4, 25))), choose(last, 1))


def _candidate(key: str, kind: Column, norm: Column, attempt: int) -> Column:
    """The surrogate of a normal form at an attempt."""
    return _once(_bytes(key, kind, norm, attempt), lambda s: _surrogate(s, kind, norm, attempt))


def _surrogate(s: Column, kind: Column, norm: Column, attempt: int) -> Column:
    extra = _extra(attempt)
    more = F.concat(*(_pick("0123456789", _byte(s, F.length(norm) + i)) for i in range(extra))) if extra else F.lit("")
    host = F.substring_index(norm, "@", -1)
    labels = F.split(host, r"\.")
    under = F.array_join(F.slice(labels, 1, F.greatest(F.size(labels) - 2, F.lit(0))), ".")
    email = F.concat(_like(F.substring_index(norm, "@", 1), s), more, F.lit("@"),
                     F.when(F.size(labels) > 2, F.concat(_like(under, F.transform(F.reverse(s), F.reverse)), F.lit("."))).otherwise(""),
                     F.lit("example."), F.element_at(labels, -1))
    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (_byte(s, i) % 254 + 1).cast("string")), ".")
    body = F.concat(F.left(norm, F.lit(1)), _like(F.substring(norm, F.lit(2), F.length(norm) - 2), s), more)
    check = (F.lit(10) - luhn(F.concat(body, F.lit("0")))) % 10
    letters = F.lit("0123456789abcdef")
    hexed = F.array_join(F.transform(F.split(norm, ""), lambda c, i: F.when(c == ":", c).otherwise(
        F.substring(letters, _byte(s, i) % 16 + 1, F.lit(1)))), "")
    prefix = F.regexp_extract(norm, _KEY_PREFIX, 0)
    account = F.concat(_like(F.substring(norm, F.lit(5), F.length(norm)), s), more)
    number = F.lpad((F.lit(98) - iban_rest(F.concat(F.left(norm, F.lit(2)), F.lit("00"), account))).cast("string"), 2, "0")
    out = (F.when(kind == "email", email).when(kind == "ip", F.concat_ws(".", octets, more) if extra else octets)
           .when(kind.isin("phone", "ssn"), F.concat(_like(norm, s, "23456789"), more))
           .when(kind == "card", F.concat(body, check.cast("string")))
           .when(kind == "key", F.concat(prefix, _like(F.substring(norm, F.length(prefix) + 1, F.length(norm)), s), more))
           .when(kind == "iban", F.concat(F.left(norm, F.lit(2)), number, account))
           .when(kind.isin("hex", "ip6") | norm.rlike("^[0-9a-f]+$") & (kind == "secret"), F.concat(hexed, more))
           .when(kind == "secret", F.concat(_like(norm, s), more)))
    for script in _SYLLABLES:
        for g, gender in enumerate(("male", "female")):
            out = out.when(kind == f"given {gender} {script}", _name(script, 2 + g, s, attempt))
            out = out.when(kind == f"family {gender} {script}", _name(script, 4 + g, s, attempt))
    return out.when(kind == "given neutral Latin", _name("Latin", 6, s, attempt))


def surrogates(values: DataFrame, key: str) -> DataFrame:
    """(kind, norm, surrogate) for distinct (kind, norm): distinct within a kind, and none an original."""
    todo = values = reliable_checkpoint(values.select("kind", "norm").distinct())
    done = None
    taken = values.select(F.col("kind").alias("k"), F.col("norm").alias("s"))
    for attempt in itertools.count():
        tried = todo.withColumn("surrogate", _candidate(key, F.col("kind"), F.col("norm"), attempt))
        free = tried.join(taken, (F.col("kind") == F.col("k")) & (F.col("surrogate") == F.col("s")), "left_anti")
        first = Window.partitionBy("kind", "surrogate").orderBy("norm")
        won = reliable_checkpoint(free.withColumn("n", F.row_number().over(first)).where("n = 1").drop("n"))
        done = won if done is None else done.unionByName(won)
        todo = reliable_checkpoint(todo.join(won, ["kind", "norm"], "left_anti"))
        if todo.isEmpty():
            return done
        taken = taken.union(won.select("kind", "surrogate"))


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _norm(kind: Column, v: Column) -> Column:
    return (F.when(kind.isin("email", "ip6"), F.lower(v)).when(kind == "iban", F.replace(v, F.lit(" "), F.lit(""))).when(kind == "phone", F.right(_digits(v), F.greatest(F.lit(10), F.length(_digits(v)) - 3)))
            .when(kind.isin("card", "ssn"), _digits(v)).when(kind.startswith("given") | kind.startswith("family"), F.initcap(F.lower(v)))
            .otherwise(v))


def _written(kind: Column, v: Column, s: Column) -> Column:
    """A surrogate in the written form of the value it replaces."""
    digits = F.length(_digits(v))
    skip = digits - F.length(_norm(kind, v))                  # a country code stays

    def one(c: Column, i: Column) -> Column:
        nth = F.length(_digits(F.substring(v, F.lit(1), i + 1))) - skip
        return F.when(c.rlike("[0-9]") & (nth > 0), F.substring(s, nth, F.lit(1))).otherwise(c)
    numbered = F.concat(F.array_join(F.transform(F.split(v, ""), one), ""), F.substring(s, F.length(_norm(kind, v)) + 1, F.lit(99)))
    shout = (v == F.upper(v)) & (F.length(v) > 1) & (kind.startswith("given") | kind.startswith("family") | kind.isin("email", "ip6"))
    account = F.concat(F.array_join(F.transform(F.split(v, ""), lambda c, i: F.when(c == " ", c).otherwise(
        F.substring(s, F.length(F.replace(F.substring(v, F.lit(1), i + 1), F.lit(" "), F.lit(""))), F.lit(1)))), ""),
        F.substring(s, F.length(_norm(kind, v)) + 1, F.lit(99)))
    return F.when(kind == "iban", account).when(kind.isin("phone", "card", "ssn"), numbered).when(shout, F.upper(s)).otherwise(s)


def _people(t: Column) -> Column:
    """(name, kind) of the persons' names in a text."""
    def names(title: Column, one: Column, two: Column) -> Column:
        script = F.when(one.rlike(r"^\p{IsCyrillic}"), F.lit("Cyrillic")).when(one.rlike(r"^\p{IsGreek}"), F.lit("Greek")).otherwise(F.lit("Latin"))
        bare = F.regexp_replace(title, r"[.\s ]", "")
        gender = (F.when(bare.isin(*FEMALE), "female").when(~bare.isin(*NEUTRAL), "male").when(script == "Latin", "neutral")
                  .when((script == "Cyrillic") & one.rlike("[ая]$") | (script == "Greek") & ~one.rlike("ς$"), "female").otherwise("male"))
        # family names differ by gender in some scripts only
        of = F.when(script == "Latin", F.lit("male")).otherwise(gender)
        family = F.when(two == "", one).otherwise(two)
        return F.array(F.struct(family.alias("name"), F.concat_ws(" ", F.lit("family"), of, script).alias("kind")),
                       F.struct(F.when(two != "", one).alias("name"), F.concat_ws(" ", F.lit("given"), gender, script).alias("kind")))
    both = F.arrays_zip(F.regexp_extract_all(t, F.lit(PERSON), F.lit(1)).alias("a"), F.regexp_extract_all(t, F.lit(PERSON), F.lit(2)).alias("b"),
                        F.regexp_extract_all(t, F.lit(PERSON), F.lit(3)).alias("c"))
    return F.array_distinct(F.filter(F.flatten(F.transform(both, lambda x: names(x["a"], x["b"], x["c"]))), lambda x: x["name"].isNotNull()))


def _parts(v: Column, people: Column) -> Column:
    """A match as (kind or null, written) parts; parts without kind stay."""
    def part(kind, written: Column) -> Column:
        kind = F.lit(kind).cast("string") if kind is None or isinstance(kind, str) else kind
        return F.struct(kind.alias("kind"), written.alias("written"))

    def whole(kind: str) -> Column:
        return F.array(part(kind, v))

    def name(n: Column) -> Column:
        return part(F.element_at(F.filter(people, lambda x: x["name"] == n), 1)["kind"], n)
    title, one, two = (F.regexp_extract(v, PERSON, i) for i in (1, 2, 3))
    person = F.when(two == "", F.array(part(None, title), name(one))).otherwise(
        F.array(part(None, title), name(one), part(None, F.lit(" ")), name(two)))
    prefix = F.regexp_extract(v, _SECRET_PREFIX, 0)
    value = F.substring(v, F.length(prefix) + 1, F.length(v))
    account = F.when(iban_rest(F.replace(v, F.lit(" "), F.lit(""))) == 1, whole("iban")).otherwise(F.array(part(None, v)))
    return (F.when(prefix != "", F.array(part(None, prefix), part(F.when(value.rlike(rf"^(?:{KEY})$"), "key").when(value.rlike(rf"^(?:{HEX})$"), "hex").otherwise("secret"), value)))
            .when(title != "", person)
            .when(F.exists(people, lambda x: x["name"] == v), F.array(name(v)))
            .when(v.contains("@"), whole("email")).when(v.rlike(rf"^(?:{IPV4})$"), whole("ip"))
            .when(v.rlike(rf"^(?:{IPV6})$"), whole("ip6"))
            .when(v.rlike(rf"^(?:{KEY})$"), whole("key")).when(v.rlike(rf"^(?:{IBAN})$"), account).when(v.rlike(rf"^(?:{SSN})$"), whole("ssn"))
            .when(v.rlike(rf"^(?:{CARD})$"), F.when(luhn(_digits(v)) == 0, whole("card")).otherwise(F.array(part(None, v))))
            .when(v.rlike(rf"^(?:{HEX})$"), whole("hex")).otherwise(whole("phone")))


def replace(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """(``row``: the whole input row with its text replaced, ``n_entities``: values replaced in it)."""
    text = F.col("t")
    base = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("t"))
    found = F.coalesce((text.rlike(_MARK) & text.rlike(NUMBERED)) | text.rlike(PERSON), F.lit(False))
    texts = reliable_checkpoint(base.where(found).select(F.sha2("t", 256).alias("id"), "t").dropDuplicates(["id"]))
    people = texts.select("id", "t", F.when(text.rlike(PERSON), _people(text)).otherwise(
        F.array().cast("array<struct<name:string,kind:string>>")).alias("people"))
    names = F.array_join(F.array_distinct(F.transform("people", lambda x: x["name"])), "|")
    pattern = F.when(F.size("people") == 0, F.lit(BASE)).otherwise(
        F.concat(F.lit(BASE + r"|(?<![\p{L}\p{N}])(?:"), names, F.lit(r")(?![\p{L}\p{N}])")))
    cut = people.withColumn("p", pattern)
    between = cut.select("id", F.posexplode(F.split("t", F.col("p"), -1)).alias("at", "s")).select(
        "id", (F.col("at") * 2).alias("at"), F.lit(0).alias("sub"), "s", F.lit(0).alias("n"))
    matches = cut.select("id", "people", F.posexplode(F.regexp_extract_all("t", F.col("p"), F.lit(0))).alias("at", "v"))
    parts = reliable_checkpoint(
        matches.select("id", (F.col("at") * 2 + 1).alias("at"), F.posexplode(_parts(F.col("v"), F.col("people"))).alias("sub", "x"))
        .select("id", "at", "sub", "x.kind", "x.written").withColumn("norm", _norm(F.col("kind"), F.col("written"))))
    known = surrogates(parts.where("kind is not null"), key).select(F.col("kind").alias("k"), F.col("norm").alias("m"), "surrogate")
    put = parts.join(known, (F.col("kind") == F.col("k")) & (F.col("norm") == F.col("m")), "left").select(
        "id", "at", "sub", F.when(F.col("kind").isNull(), F.col("written")).otherwise(
            _written(F.col("kind"), F.col("written"), F.col("surrogate"))).alias("s"), F.col("kind").isNotNull().cast("int").alias("n"))
    new = (between.unionByName(put).groupBy("id").agg(F.sort_array(F.collect_list(F.struct("at", "sub", "s"))).alias("all"), F.sum("n").alias("n"))
           .select(F.col("id").alias("of"), F.array_join(F.transform("all", lambda x: x["s"]), "").alias("new"), "n"))
    changed = base.where(found).withColumn("id", F.sha2("t", 256)).join(new, F.col("id") == F.col("of"))
    return (changed.select(F.col("row").withField(f"`{text_col}`", F.col("new")).alias("row"), F.col("n").alias("n_entities"))
            .unionByName(base.where(~found).select("row", F.lit(0).cast("long").alias("n_entities"))))
