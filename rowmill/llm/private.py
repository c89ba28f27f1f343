"""Personal data replaced by surrogates, with DataFrame functions only.

Detected entities get keyed replacements of their own kind and format: digits for digits,
letters for letters of the same case, valid octets, the same country code, separators and
top-level domain, a given name of the gender its title tells, a surname in its script, the
issuer, length and check digit of a card, the check digits of an IBAN, the prefix of a key,
the zero groups of an IPv6 address. Card numbers of other lengths than 16 count only with a
right check digit. The
same entity gets the same surrogate everywhere, however it is written (coreference); two
different ones never share one, and none is an entity of the input: a check over all
distinct entities moves those that clash on to their next surrogate, until none does. After
some tries names get longer and e-mail domains change too; what finds no free surrogate of
its form in ``TRIES`` is masked, and only masks can be shared.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.functions.text import let
from rowmill.llm.frames import written

# What joins the parts of a number: a blank, dot or dash, after a few marks of noise, or a cell border.
_JOIN = r"(?:[!#$%&*]{0,3}[ .\-]| \| )"
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "г-жа", "Госпожа")
MALE_TITLES = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "г-н", "Господин")
OTHER_TITLES = ("Dr", "Prof")
_WORD = r"\p{Lu}[\p{L}\p{M}'’\-]{1,40}"
#: Initials, with dots or without, before a word of a name.
_INITIALS = r"(?:\p{Lu}\.?(?:[ \-]?\p{Lu}\.)* )*"
#: One group of an IPv6 address.
_HEX = "[0-9A-Fa-f]{1,4}"
#: Keys and tokens known by how they begin: the beginning, which stays, and the rest.
KEY_FORMS = (
    ("(?:AKIA|ASIA)", "[0-9A-Z]{16}"),
    ("AIza", r"[0-9A-Za-z_\-]{35}"),
    ("gh[pousr]_", "[0-9A-Za-z]{36,255}+"),
    ("xox[abprs]-", r"[0-9A-Za-z\-]{10,255}+"),
    ("[spr]k[_-](?:(?:live|test|proj)[_-])?", "[0-9A-Za-z]{16,255}+"),
    ("eyJ", r"[0-9A-Za-z_\-]{8,}+\.[0-9A-Za-z_\-]{8,}+\.[0-9A-Za-z_\-]{8,}+"),
)
#: Kinds in the order they are tried. Each begins where nothing like it goes before, so a
#: long run of letters or digits is passed over in one step.
KINDS = {
    "email": (
        r"(?<![\p{IsLatin}0-9._%+\-])[\p{IsLatin}0-9._%+\-]++@[\p{IsLatin}0-9\-]+(?:\.[\p{IsLatin}0-9\-]+)*\.[A-Za-z]{2,24}"
        r"(?![\p{IsLatin}0-9\-])"
    ),
    "key": rf"(?<![0-9A-Za-z])(?:{'|'.join(a + b for a, b in KEY_FORMS)})(?![0-9A-Za-z])",
    "secret": r"(?<![0-9A-Za-z])[0-9A-Fa-f]{32,128}+(?![0-9A-Za-z])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "card": (
        r"(?<![0-9])(?:[0-9]{4}(?<gap>[ \-]?)[0-9]{4}\k<gap>[0-9]{4}\k<gap>[0-9]{4}|3[47][0-9]{2}(?<amex>[ \-]?)[0-9]{6}\k<amex>[0-9]{5}"
        r"|3(?:0[0-5]|[689][0-9])[0-9](?<diners>[ \-]?)[0-9]{6}\k<diners>[0-9]{4}|4[0-9]{12}(?:[0-9]{6})?|(?:5[06-9]|6[0-9])[0-9]{11,17})(?![0-9])"
    ),
    "ipv6": (
        rf"(?<![0-9A-Za-z:.])(?=[A-Fa-f:]*[0-9])(?:(?:{_HEX}:){{7}}{_HEX}|[0-9A-Fa-f]{{3,4}}(?::{_HEX}){{0,4}}::(?:{_HEX}(?::{_HEX}){{0,4}})?)(?![0-9A-Za-z:])"
    ),
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?!\.?[0-9])",
    "ssn": r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])",
    "phone": (
        rf"(?<![0-9+])\+[0-9]{{1,3}}{_JOIN}?\(?[0-9]{{2,4}}\)?{_JOIN}?[0-9]{{3,4}}(?:{_JOIN}?[0-9]{{2,4}}){{0,3}}(?![0-9])"
        r"|(?<![0-9+.\-])0[0-9]{2,4}(?<space>[ \-])[0-9]{3,4}\k<space>[0-9]{3,4}(?![0-9])"
        rf"|(?<![0-9])\([0-9]{{3}}\){_JOIN}?[0-9]{{3}}[.\-][0-9]{{4}}(?![0-9])|(?<![0-9.\-])[0-9]{{3}}(?<dash>[.\-])[0-9]{{3}}\k<dash>[0-9]{{4}}(?![0-9])"
    ),
    "name": rf"(?<!\p{{L}})(?:{'|'.join(FEMALE_TITLES + MALE_TITLES + OTHER_TITLES)})\.? {_INITIALS}{_WORD}(?: {_INITIALS}{_WORD})*",
}
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())
#: A text without any of these has no entity; most are told so at once.
HINT = r"[0-9@]|" + "|".join((*FEMALE_TITLES, *MALE_TITLES, *OTHER_TITLES, *(begin for begin, _ in KEY_FORMS)))

# Given names to choose from, by gender and script.
FEMALE_NAMES = ("Anna", "Clara", "Elena", "Greta", "Ida", "Julia", "Laura", "Maria", "Nina", "Paula", "Sofia", "Vera")
MALE_NAMES = ("Anton", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Ivan", "Jonas", "Leo", "Oscar", "Victor")
FEMALE_CYRILLIC = ("Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Нина", "Ольга")
MALE_CYRILLIC = ("Антон", "Борис", "Виктор", "Глеб", "Иван", "Максим", "Олег", "Павел")

#: An entity that still clashes after so many surrogates is masked.
TRIES = 40
#: After so many, and again each time, a name gets a letter more and an e-mail another domain.
WIDEN = 8


def _alphabets() -> list[str]:
    """The letters of each script but Latin, Cyrillic, Han and Hangul, small ones where there are any."""
    scripts: dict[str, list[str]] = {}
    for c in map(chr, range(0x370, 0x20000)):
        if unicodedata.category(c) in ("Ll", "Lo"):
            scripts.setdefault(unicodedata.name(c, "").split(" ")[0], []).append(c)
    plain = lambda c: c.upper() != c and c.upper().lower() == c and " WITH " not in unicodedata.name(c)
    cased = {name: [c for c in own if plain(c)] for name, own in scripts.items()}
    left_out = ("", "LATIN", "CYRILLIC", "CJK", "HANGUL", "TANGUT", "KHITAN", "NUSHU")
    return ["".join(cased[name] or own) for name, own in scripts.items() if name not in left_out and len(cased[name] or own) > 1]


ALPHABETS = (*_alphabets(), "".join(map(chr, range(0x4E00, 0x4E80))), "".join(map(chr, range(0xAC00, 0xAC80))))


def _texts(values: tuple[str, ...]) -> Column:
    return F.array(*map(F.lit, values))


def kind_of(value: Column) -> Column:
    """The kind of what the patterns found, null for digits that only look like a card."""
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(KINDS.items()):
        found = F.lit(kind)
        if kind == "card":
            digits = F.regexp_replace(value, "[^0-9]", "")
            found = F.when((F.length(digits) == 16) | (F.pmod(_luhn(digits), F.lit(10)) == 0), found)
        out = F.when(value.rlike(f"^(?:{pattern})$"), found).otherwise(out)
    return out


def _luhn(digits: Column) -> Column:
    """The sum of a card's digits, every second one from the right doubled, by cross sums."""

    def total(all_: Column) -> Column:
        numbers = F.transform(F.split(all_, ""), lambda c: F.coalesce(c.try_cast("int"), F.lit(0)))
        each = F.transform(numbers, lambda n, i: F.when(F.pmod(F.length(all_) - i, F.lit(2)) == 0, n * 2 - F.when(n > 4, 9).otherwise(0)).otherwise(n))
        return F.aggregate(each, F.lit(0), lambda so_far, n: so_far + n)

    return let(digits, total)


def _remainder(letters: Column) -> Column:
    """The remainder by 97 of digits and capitals, A as 10 to Z as 35."""

    def step(rest: Column, c: Column) -> Column:
        digit = c.rlike("^[0-9]$")
        return F.pmod(rest * F.when(digit, 10).otherwise(100) + F.ascii(c) - F.when(digit, 48).otherwise(55), F.lit(97))

    return F.aggregate(F.split(letters, ""), F.lit(0), step)


def _parts(half: Column) -> Column:
    return F.filter(F.split(F.coalesce(half, F.lit("")), ":"), lambda g: g != "")


def _halves(address: Column) -> tuple[Column, Column]:
    """The groups before and after the two colons of an IPv6 address."""
    halves = F.split(address, "::")
    return _parts(F.get(halves, F.lit(0))), _parts(F.get(halves, F.lit(1)))


def _full(address: Column) -> Column:
    """All eight groups of an IPv6 address, with four digits each."""
    left, right = _halves(F.lower(address))
    zeros = F.array_repeat(F.lit("0"), F.greatest(8 - F.size(left) - F.size(right), F.lit(0)))
    return F.array_join(F.transform(F.concat(left, zeros, right), lambda g: F.lpad(g, 4, "0")), ":")


def _as_short(value: Column, canon: Column) -> Column:
    """A full IPv6 address with the colons and the widths of groups of another."""
    left, right = _halves(value)
    groups = F.split(canon, ":")
    wide = lambda at, g: F.substring(F.get(groups, at), 5 - F.length(g), F.length(g))
    before = F.array_join(F.transform(left, lambda g, i: wide(i, g)), ":")
    after = F.array_join(F.transform(right, lambda g, i: wide(i + 8 - F.size(right), g)), ":")
    text = F.when(value.contains("::"), F.concat(before, F.lit("::"), after)).otherwise(before)
    return F.when(value.rlike("[A-F]"), F.upper(text)).otherwise(text)


def canonical(kind: Column, value: Column) -> Column:
    """What an entity is, without how it is written."""
    return (
        F.when(kind.isin("iban", "card", "ssn", "phone"), F.regexp_replace(value, "[^0-9A-Za-z]", ""))
        .when(kind.isin("email", "secret"), F.lower(value))
        .when(kind == "ipv6", _full(value))
        .otherwise(value)
    )


def _bytes(key: str, salt: Column | str, what: Column, attempt: Column) -> Column:
    """128 keyed bytes as hex text."""
    salt = F.lit(salt) if isinstance(salt, str) else salt
    return F.concat(*[F.sha2(F.concat_ws("\u0001", F.lit(key), salt, what, attempt.cast("string"), F.lit(str(n))), 256) for n in range(4)])


def _byte(stream: Column, place: Column) -> Column:
    return F.conv(F.substring(stream, F.pmod(place, F.lit(128)) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(letters: str, number: Column) -> Column:
    return F.substring(F.lit(letters), F.pmod(number, F.lit(len(letters))) + 1, F.lit(1))


def _each(text: Column, change) -> Column:
    return F.array_join(F.transform(F.split(text, ""), change), "")


def _alike(text: Column, stream: Column, keep: Column | int = 0) -> Column:
    """Other digits and small letters in their places, from place ``keep`` on."""
    return _each(
        text,
        lambda c, i: F.when((i >= keep) & c.rlike("^[0-9]$"), F.pmod(_byte(stream, i), F.lit(10)).cast("string"))
        .when((i >= keep) & c.rlike("^[a-z]$"), _pick("abcdefghijklmnopqrstuvwxyz", _byte(stream, i)))
        .when((i >= keep) & c.rlike("^[A-Z]$"), _pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", _byte(stream, i)))
        .when((i >= keep) & c.rlike(r"^\p{IsLatin}$"), _pick("àáâäãåèéêëìíîïòóôöùúûü", _byte(stream, i)))
        .otherwise(c),
    )


def _same_script(low: Column, b: Column) -> Column:
    """Another letter of a letter's alphabet. Those in none (rare letters) become one of Greek, Han or Hangul."""
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(low, r"^\p{IsHan}$", "\u4e00"), r"^\p{IsHangul}$", "\uac00"), r"^\p{IsGreek}$", "α")
    own = F.coalesce(F.get(F.filter(F.split(F.lit("\n".join(ALPHABETS)), "\n"), lambda a: a.contains(plain)), F.lit(0)), F.lit(ALPHABETS[0]))

    def shifted(letters: Column) -> Column:
        """By at least one letter, so that none stays."""
        size = F.length(letters)
        return F.substring(letters, F.pmod(F.instr(letters, low) + F.pmod(b, size - 1), size) + 1, F.lit(1))

    # the alphabets are a long text: one copy in the plan for each use
    return let(own, shifted)


def _named_alike(word: Column, stream: Column) -> Column:
    """A word of the same length, script and capitals, vowels for vowels."""

    def change(c: Column, i: Column) -> Column:
        low, b = F.lower(c), _byte(stream, i)
        other = (
            F.when(low.rlike("^[аеёиоуыэюя]$"), _pick("аеиоу", b))
            .when(low.rlike(r"^\p{IsCyrillic}$"), _pick("бвгдзклмнпрст", b))
            .when(low.rlike(r"^[aeiouyàáâäãåæèéêëìíîïòóôöõøùúûüœ]$"), _pick("aeiou", b))
            .when(low.rlike(r"^\p{IsLatin}$"), _pick("bdfgklmnprstvw", b))
            .when(low.rlike(r"^\p{L}$"), _same_script(low, b))
            .otherwise(low)
        )
        return let(other, lambda o: F.when(c == low, o).otherwise(F.upper(o)))

    return _each(word, change)


def with_surrogates(key: str, entities: Column) -> Column:
    """An array of structs with kind, canon and attempt, each with ``new`` added: the
    canonical form of its surrogate. Step by step, so that no keyed bytes are made twice."""
    domain = lambda e: F.substring_index(e["canon"], "@", -1)
    surname = lambda e: F.substring_index(e["canon"], " ", -1)

    def keyed(e: Column) -> Column:
        email = e["kind"] == "email"
        apart = _bytes(
            key,
            F.when(email, F.lit("domain")).otherwise(F.lit("surname")),
            F.when(email, domain(e)).otherwise(surname(e)),
            F.when(email, F.floor(e["attempt"] / WIDEN).cast("int")).otherwise(e["attempt"]),
        )
        return F.struct(
            e.alias("e"),
            _bytes(key, e["kind"], e["canon"], e["attempt"]).alias("own"),
            F.when(e["kind"].isin("email", "name"), apart).alias("apart"),
        )

    return F.transform(F.transform(entities, keyed), lambda s: s["e"].withField("new", _surrogate(s["e"], s["own"], s["apart"])))


def _surrogate(e: Column, stream: Column, apart: Column) -> Column:
    kind, canon = e["kind"], e["canon"]
    domain = F.substring_index(canon, "@", -1)
    last = F.length(F.substring_index(domain, ".", -1)) + 1
    email = F.concat(
        _alike(F.substring_index(canon, "@", 1), stream), F.lit("@"),
        _alike(F.substring(domain, F.lit(1), F.length(domain) - last), apart), F.substring(domain, F.length(domain) - last + 1, last),
    )
    octets = F.concat_ws(".", *[_byte(stream, F.lit(n)).cast("string") for n in range(4)])
    words = F.split(canon, " ")
    title, surname = F.element_at(words, 1), F.element_at(words, -1)
    bare = F.regexp_replace(title, r"\.$", "")
    first = _byte(stream, F.lit(0)) * 256 + _byte(stream, F.lit(1))
    female = F.when(bare.isin(*FEMALE_TITLES), True).when(bare.isin(*MALE_TITLES), False).otherwise(F.pmod(first, F.lit(2)) == 0)
    names = (
        F.when(female & surname.rlike(r"\p{IsCyrillic}"), _texts(FEMALE_CYRILLIC))
        .when(female, _texts(FEMALE_NAMES))
        .when(surname.rlike(r"\p{IsCyrillic}"), _texts(MALE_CYRILLIC))
        .otherwise(_texts(MALE_NAMES))
    )
    known = surname.rlike(r"\p{IsCyrillic}|\p{IsLatin}")

    def middle(word: Column, i: Column) -> Column:
        """An initial for an initial, the first given name by its title, others as they come."""
        shifted = F.concat(F.substring(stream, i * 8 + 1, F.lit(256)), stream)
        given = let(names, lambda own: F.get(own, F.pmod(first + i * _byte(stream, i + 2), F.size(own))))
        return F.when(known & ~word.rlike(r"^\p{Lu}(?:\.|$)"), given).otherwise(_named_alike(word, shifted))

    longer = F.floor(e["attempt"] / WIDEN).cast("int")
    added = F.substring(_named_alike(F.repeat(F.lower(F.substring(surname, 2, 1)), TRIES), F.reverse(apart)), F.lit(1), longer)
    more = F.when(longer > 0, added).otherwise("")
    parts = F.transform(F.slice(words, F.lit(2), F.greatest(F.size(words) - 2, F.lit(0))), middle)
    name = F.concat_ws(" ", title, parts, F.concat(_named_alike(surname, apart), more))
    masked = F.regexp_replace(F.regexp_replace(F.when(kind == "name", F.substring(canon, F.length(title) + 1, F.length(canon))).otherwise(canon), "[0-9]", "0"), "[^0@. ]", "x")
    masked = F.when(kind == "ipv6", F.regexp_replace(canon, "[0-9a-f]", "0")).otherwise(masked)
    begin = F.length(F.regexp_extract(canon, f"^(?:{'|'.join(begin for begin, _ in KEY_FORMS)})", 0))
    country = F.greatest(F.length(canon) - 10, canon.startswith("0").cast("int"))
    keep = F.when(kind == "iban", 2).when(kind == "phone", country).when(kind == "key", begin).otherwise(0)
    issuer = F.when(F.length(canon) == 16, 1).otherwise(3)
    card = _alike(F.substring(canon, F.lit(1), F.length(canon) - 1), stream, issuer)
    check = lambda c: F.pmod(10 - F.pmod(_luhn(F.concat(c, F.lit("0"))), F.lit(10)), F.lit(10)).cast("string")
    land, account = F.substring(canon, 1, 2), _alike(F.substring(canon, F.lit(5), F.length(canon)), stream)
    checks = lambda a: F.lpad((98 - _remainder(F.concat(a, land, F.lit("00")))).cast("string"), 2, "0")

    def group(c: Column, i: Column) -> Column:
        """The first digit and the zeros that begin a group stay."""
        begins = F.substring(canon, F.lit(1), i).rlike("(?:^|:)0*$")
        return (
            F.when((i == 0) | (c == ":") | (begins & (c == "0")), c)
            .when(begins, _pick("123456789abcdef", _byte(stream, i)))
            .otherwise(_pick("0123456789abcdef", _byte(stream, i)))
        )

    return (
        F.when(kind.isNull(), canon)
        .when(e["attempt"] >= TRIES, F.concat(F.when(kind == "name", title).otherwise(""), masked))
        .when(kind == "email", email)
        .when(kind == "ip", octets)
        .when(kind == "card", let(card, lambda c: F.concat(c, check(c))))
        .when(kind == "iban", let(account, lambda a: F.concat(land, checks(a), a)))
        .when(kind == "ipv6", _each(canon, group))
        .when(kind == "name", name)
        .when(kind == "secret", _each(canon, lambda c, i: _pick("0123456789abcdef", _byte(stream, i))))
        .otherwise(_alike(canon, stream, keep))
    )


def written_as(kind: Column, value: Column, canon: Column) -> Column:
    """A surrogate's canonical form, written as the entity was: its separators, its case."""
    filled = F.aggregate(
        F.split(value, ""),
        F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda done, c: F.when(
            c.rlike("^[0-9A-Za-z]$"),
            F.struct(F.concat(done["out"], F.substring(canon, done["at"], F.lit(1))).alias("out"), (done["at"] + 1).alias("at")),
        ).otherwise(F.struct(F.concat(done["out"], c).alias("out"), done["at"].alias("at"))),
    )["out"]
    cased = F.array_join(
        F.zip_with(F.split(value, ""), F.split(canon, ""), lambda was, now: F.when(was.rlike(r"^\p{Lu}$"), F.upper(now)).otherwise(now)), ""
    )
    return (
        F.when(kind.isin("iban", "card", "ssn", "phone"), filled)
        .when(kind.isin("email", "secret"), cased)
        .when(kind == "ipv6", _as_short(value, canon))
        .otherwise(canon)
    )


def _entities(text: Column) -> Column:
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _moved(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon, attempt) of the distinct entities whose first surrogate clashes."""
    new = with_surrogates(key, F.array(F.struct("kind", "canon", "attempt")))[0]["new"]
    known = written(entities.distinct(), "entities")
    given = written(known.withColumn("attempt", F.lit(0)).withColumn("new", new), "surrogates")
    while True:
        first = given.groupBy("kind", "new").agg(F.min("canon").alias("keeps"), F.count("*").alias("n")).where("n > 1")
        real = known.select("kind", F.col("canon").alias("new"), F.lit(True).alias("real"))
        clashing = (
            given.join(first.select("kind", "new", "keeps"), ["kind", "new"], "left")
            .join(real, ["kind", "new"], "left")
            .select("kind", "canon", "attempt", "new", (F.coalesce("real", F.lit(False)) | (F.col("keeps") != F.col("canon"))).alias("move"))
        )
        moves = F.coalesce("move", F.lit(False)) & (F.col("attempt") < TRIES)
        checked = written(clashing.select("kind", "canon", "attempt", "new", moves.alias("move")), "surrogates")
        if checked.where("move").isEmpty():
            return checked.where("attempt > 0").select("kind", "canon", "attempt")
        given = written(
            checked.withColumn("attempt", F.col("attempt") + F.col("move").cast("int"))
            .withColumn("new", F.when(F.col("move"), new).otherwise(F.col("new")))
            .drop("move"),
            "surrogates",
        )


def replace_entities(df: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, n_entities): every text with its entities replaced.

    Texts without entities and null texts stay as they are, with 0 entities. Every input
    row gets one row; ids may be null or repeated. Other columns are left out whatever
    their names. The result depends on the key, the text and, where surrogates clash, on
    the other entities of the input.
    """
    docs = df.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        F.xxhash64(F.col(id_col), F.lit("id")).alias("kid"),
        F.xxhash64(F.col(text_col), F.lit("text")).alias("th"),
    )
    found = written(
        docs.select("kid", "th", F.explode(_entities(F.col("text"))).alias("value"))
        .withColumn("kind", kind_of(F.col("value")))
        .where("kind IS NOT NULL")
        .select("kid", "th", "kind", canonical(F.col("kind"), F.col("value")).alias("canon")),
        "mentions",
    )
    moved = written(_moved(found.select("kind", "canon"), key), "moved")
    own = (
        found.distinct().join(moved, ["kind", "canon"]).groupBy("kid", "th")
        .agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("\u0001", "kind", "canon"), "attempt"))).alias("attempts"))
    )
    if moved.isEmpty():  # as nearly always; then no text needs to be shuffled for it
        docs = docs.withColumn("attempts", F.lit(None).cast("map<string, int>"))
    else:
        docs = docs.join(own, ["kid", "th"], "left")

    def attempt(e: Column) -> Column:
        return F.coalesce(F.try_element_at("attempts", F.concat_ws("\u0001", e["kind"], e["canon"])), F.lit(0))

    values = F.coalesce(_entities(F.col("text")), F.array().cast("array<string>"))
    kinds = F.transform("values", lambda v: F.struct(v.alias("value"), kind_of(v).alias("kind")))
    canons = F.transform("kinds", lambda e: e.withField("canon", canonical(e["kind"], e["value"])))
    entities = with_surrogates(key, F.transform(canons, lambda e: e.withField("attempt", attempt(e))))
    new = F.transform(entities, lambda e: written_as(e["kind"], e["value"], e["new"]))
    between = F.split("text", PATTERN, -1)
    rebuilt = F.array_join(F.zip_with(between, new, lambda plain, made: F.concat(plain, F.coalesce(made, F.lit("")))), "")
    return docs.withColumn("values", values).withColumn("kinds", kinds).select(
        "id",
        F.when(F.size("values") > 0, rebuilt).otherwise(F.col("text")).alias("text"),
        F.size(F.filter("kinds", lambda e: e["kind"].isNotNull())).cast("long").alias("n_entities"),
    )
