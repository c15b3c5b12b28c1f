"""Personal data replaced by keyed surrogates of the same type and form.

Found are e-mail and IP addresses, phone, card, account and social security numbers, access keys, assigned secrets, names
behind a form of address, names before a bracketed mail address, and all further capitalised mentions of these names in the
same text. A surrogate is made from a keyed hash of the value, so a value has the same one in every
text and run. It keeps what kind of thing the value is: digits stay digits and letters stay letters of their script and
case, hexadecimal stays hexadecimal, card numbers keep their first digit and a valid check digit, addresses are valid,
mail domains end in a reserved name, given names follow the gender of the form of address, and a surname stands for
itself with and without the given name before it.

All distinct values form a dictionary. A surrogate that equals another value's, or a value that occurs, is made anew with
the next attempt until all differ, so distinct values stay distinct; the attempts that were needed are joined to the texts.
After every ``SAME`` attempts surrogates of short forms (names, local parts of addresses, phone numbers, secrets) get longer.

Expressions are Spark's own throughout. Defined cases: null texts stay null and empty texts empty; texts without personal
data stay as they are; of values found at one place the first kind in ``PATTERN`` holds; repeated rows get equal texts;
all columns and rows are kept. Not found are names that a text holds without either sign, a further mention of a name that
the text also has as a word in small letters, secrets below six characters (eight for passwords without a digit or quotes),
and spaces within secrets. If the values of one form that does not
get longer exceed what it can tell apart, ValueError is raised.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

# Forms of address by gender.
MALE = ["Mr", "Sir", "Herr", "Herrn", "Señor", "Sr", "Monsieur", r"M(?=\.)", "Signor", "Senhor", "господин", "г-н"]
FEMALE = ["Mrs", "Ms", "Miss", "Madam", "Frau", "Señora", "Sra", "Doña", "Dra", "Madame", "Mme", "Mlle", "Signora", "Senhora",
          "госпожа", "г-жа"]
EITHER = ["Dr", "Doctor", "Prof", "Professor", "доктор", "профессор"]

TITLES = MALE + FEMALE + EITHER
# a second form of address has a full stop or is a whole word, as short ones are names too
ADDRESSED = rf"(?:{'|'.join(TITLES)})\.?[ \u00a0](?:(?:(?:{'|'.join(TITLES)})\.|Doctor|Professor|доктор|профессор)[ \u00a0]){{0,2}}"
NAME = r"\p{Lu}(?:\p{Ll}++|(?=['’]\p{L}))(?:['’-]\p{L}\p{Ll}++)*+"
MAIL = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}\.){1,8}[A-Za-z]{2,24}"
        r"(?![A-Za-z0-9])")
#: Two or three names, as they stand before a mail address in brackets.
NAMES = rf"{NAME} {NAME}(?: {NAME})?"
SECRET = r"""(?i:password|passwd|pwd|secret|token|api[_-]?key)["']?\s{0,3}[=:]\s{0,3}["']?"""
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
ALTERNATIVES = [
    # an address: the run before the sign is taken whole, so no run is scanned twice
    MAIL,
    rf"(?<![A-Za-z0-9]){SECRET}(?=[A-Za-z+/_.~-]{{0,80}}\d)[A-Za-z0-9+/_.~-]{{6,}}+(?![@!#%&*^?])",
    # with other signs and a digit, in quotes, or a password of letters
    rf"(?<![A-Za-z0-9]){SECRET}(?=[^\s\"'<>,;()\[\]{{}}$\d]{{0,80}}\d)[^\s\"'<>,;()\[\]{{}}$]{{6,}}+(?![(\[{{])",
    rf"(?<![A-Za-z0-9]){SECRET}(?<=[\"'])[^\s\"'<>()\[\]{{}}$]{{6,}}+(?=[\"'])",
    rf"(?<![A-Za-z0-9])(?=(?i:pass|pwd)){SECRET}[^\s\"'<>,;()\[\]{{}}$]{{8,}}+(?![(\[{{])",
    r"(?<![A-Za-z0-9])(?:AKIA|ASIA)(?=[A-Z]{0,15}[0-9])[0-9A-Z]{16}(?![A-Za-z0-9])",
    r"(?<![A-Za-z0-9])(?=[A-Za-z_-]{0,40}[0-9])(?:gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,64})(?![A-Za-z0-9])",
    r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[0-9]{4}){3,7}(?: ?[0-9]{1,3})?(?![A-Za-z0-9])",
    rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?![\d]|\.\d)",
    r"(?<![A-Za-z0-9:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![A-Za-z0-9:])",
    r"(?<![A-Za-z0-9:])(?=[A-Fa-f:]{0,30}\d)(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}(?![A-Za-z0-9:])",
    r"(?<![\d+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)",
    r"(?<![\dA-Za-z.,/-])0\d{2,4}[ /-]\d{5,8}(?![\dA-Za-z])",
    r"(?<!\d)\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)",
    r"(?<![\d-])\d{3}-\d{3}-\d{4}(?![\d-])",
    r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    r"(?<![\dA-Za-z])\d(?:[ -]?\d){12,18}(?![\dA-Za-z])",
    rf"(?<!\p{{L}}){ADDRESSED}{NAME}(?: {NAME})?",
    rf"(?<!\p{{L}}){NAMES}(?= ?[<(]{MAIL}[>)])",
]
PATTERN = "|".join(ALTERNATIVES)
#: Every match has a digit, a mail sign or a word for a secret, or starts with a form of address; other texts need no
#: closer look.
HINT = rf"[0-9@]|(?i:passw|pwd|secret|token|api[_-]?key)|(?=[{''.join(sorted({t[0] for t in TITLES}))}]){ADDRESSED}"

LATIN = "abcdefghijklmnopqrstuvwxyz"
CYRILLIC = "абвгдежзийклмнопрстуфхцчшщъыьэюя"
GREEK = "αβγδεζηθικλμνξοπρστυφχψω"
HEX = "0123456789abcdef"
CONSONANTS, VOWELS = "bdfgklmnprstvz", "aeiou"
CYR_CONSONANTS, CYR_VOWELS = "бвдзклмнпрстф", "аеиоу"
BROADCAST_BYTES = 32 << 20
#: Attempts in all, and those before a surrogate gets longer by two characters.
ROUNDS, SAME = 64, 8


def pick(alphabet: str, byte: Column) -> Column:
    return F.substring(F.lit(alphabet), byte % len(alphabet) + 1, F.lit(1))


def among(c: Column, alphabet: str) -> Column:
    return F.instr(F.lit(alphabet), c) > 0


def grown(attempt: Column) -> Column:
    """By how many pairs of characters a surrogate is longer than its value."""
    return F.floor(attempt / SAME).cast("int")


def longer(value: Column, pair: str, attempt: Column) -> Column:
    return F.concat(value, F.repeat(F.lit(pair), grown(attempt)))


def stream(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """Hex digits, two for every character of the value and a few more, from a keyed hash."""
    seed = F.sha2(F.concat_ws("\u0001", F.lit(key), kind, value, attempt.cast("string")).cast("binary"), 256)
    return F.array_join(F.transform(F.sequence(F.lit(0), F.floor((F.length(value) + 2 * grown(attempt)) / 32).cast("int")), lambda j: F.sha2(
        F.concat(seed, F.lit(key), j.cast("string")).cast("binary"), 256)), "")


def byte_at(digits: Column, i: Column) -> Column:
    return F.conv(F.substring(digits, i * 2 + 1, F.lit(2)), 16, 10).cast("int")


def bound(value: Column, use) -> Column:
    """``use`` applied to a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def characters(value: Column, change) -> Column:
    """A value with ``change(character, place)`` for each character."""
    return F.when(F.length(value) > 0, F.array_join(F.transform(F.sequence(F.lit(0), F.length(value) - 1), lambda i: bound(
        F.substring(value, i + 1, F.lit(1)), lambda c: change(c, i))), "")).otherwise("")


def like(value: Column, digits: Column) -> Column:
    """Digits for digits, letters for letters of the same script and case; hexadecimal stays so; signs stay."""
    hexadecimal = value.rlike("^(?=.*[a-f])(?=.*[0-9])[0-9a-f:]+$")

    def change(c, i):
        b = byte_at(digits, i)
        out = F.when(among(c, "0123456789"), F.when(hexadecimal, pick(HEX, b)).otherwise(pick("0123456789", b)))
        out = out.when(hexadecimal & (c != ":"), pick(HEX, b))
        for alphabet in (LATIN, CYRILLIC, GREEK):
            out = out.when(among(c, alphabet), pick(alphabet, b)).when(among(c, alphabet.upper()), pick(alphabet.upper(), b))
        return out.when(c.rlike(r"\p{Lu}"), pick(LATIN.upper(), b)).when(c.rlike(r"\p{L}"), pick(LATIN, b)).otherwise(c)

    return characters(value, change)


def luhn(number: Column) -> Column:
    """Sum of a digit string's digits, every second one from the right doubled (and its digits summed)."""
    n = F.length(number)
    terms = F.transform(F.sequence(F.lit(0), n - 1), lambda i: bound(
        F.substring(number, i + 1, F.lit(1)).cast("int") * (1 + (n - 1 - i) % 2), lambda d: F.when(d > 9, d - 9).otherwise(d)))
    return F.aggregate(terms, F.lit(0), lambda a, d: a + d)


def card(value: Column, digits: Column) -> Column:
    """First digit kept, a valid check digit where the value has one."""
    plain = F.regexp_replace(value, "[^0-9]", "")
    body = F.concat(F.substring(value, 1, 1), characters(
        F.substring(value, F.lit(2), F.length(value) - 2),
        lambda c, i: F.when(among(c, "0123456789"), pick("0123456789", byte_at(digits, i + 1))).otherwise(c)))
    free = pick("0123456789", byte_at(digits, F.length(value)))
    check = lambda b: ((10 - luhn(F.concat(F.regexp_replace(b, "[^0-9]", ""), F.lit("0"))) % 10) % 10).cast("string")
    return bound(body, lambda b: F.concat(b, F.when(luhn(plain) % 10 == 0, check(b)).otherwise(free)))


def phone(value: Column, digits: Column) -> Column:
    """The country code, or the 0 before an area code, stays; a group's first digit is not 0 where it was not."""
    code = F.regexp_extract(value, r"^(\+\d{1,3}(?!\d)|0)", 1)
    rest = F.substring(value, F.length(code) + 1, F.length(value))
    return F.concat(code, characters(rest, lambda c, i: F.when(c == "0", pick("0123456789", byte_at(digits, i))).when(
        among(c, "123456789"), pick("123456789", byte_at(digits, i))).otherwise(c)))


def ip(digits: Column) -> Column:
    return F.concat_ws(".", *[(byte_at(digits, F.lit(i)) % 254 + 1).cast("string") for i in range(4)])


def email(value: Column, digits: Column, key: str) -> Column:
    """Local part like the value's; the domain, keyed by itself, ends in a name that is reserved for examples."""
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    labels = F.regexp_extract(F.lower(domain), r"^(.*)\.[^.]+\.[^.]+$", 1)
    ending = F.lower(F.substring_index(domain, ".", -1))
    reserved = F.when(ending.isin("com", "org", "net"), F.concat(F.lit("example."), ending)).otherwise("example.com")
    own = bound(stream(F.lit("domain"), F.lower(domain), F.lit(0), key), lambda d: F.when(
        labels == "", characters(F.lit("xxxx"), lambda c, i: pick(LATIN, byte_at(d, i)))).otherwise(like(labels, d)))
    return F.concat(like(local, digits), F.lit("@"), own, F.lit("."), reserved)


def name(kind: Column, value: Column, digits: Column) -> Column:
    """Consonants and vowels in turn, in the value's script and length; female given names end in a, male ones do not."""
    cyrillic = value.rlike(r"\p{IsCyrillic}")
    last = F.length(value) - 1

    def change(c, i):
        b = byte_at(digits, i)
        choose = lambda one, two: F.when(cyrillic, pick(two, b)).otherwise(pick(one, b))
        plain = F.when(i % 2 == 0, choose(CONSONANTS, CYR_CONSONANTS)).otherwise(choose(VOWELS, CYR_VOWELS))
        letter = F.when((i == last) & (kind == "female"), F.when(cyrillic, "а").otherwise("a")).when(
            (i == last) & (kind == "male"), choose(CONSONANTS, CYR_CONSONANTS)).otherwise(plain)
        return F.when(c.rlike(r"\p{Lu}"), F.upper(letter)).when(c.rlike(r"\p{L}"), letter).otherwise(c)

    return characters(value, change)


def surrogate(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """The replacement of a value of a kind at an attempt."""
    more = lambda pair: longer(value, pair, attempt)
    local = F.substring_index(value, "@", 1)
    mail = F.concat(longer(local, "aa", attempt), F.substring(value, F.length(local) + 1, F.length(value)))
    return bound(stream(kind, value, attempt, key), lambda d: F.when(kind == "email", email(mail, d, key))
                 .when(kind == "ip", ip(d)).when(kind == "phone", phone(more("00"), d)).when(kind == "card", card(value, d))
                 .when(kind.isin("male", "female", "given", "surname"), name(kind, more("aa"), d))
                 .when(kind == "key", F.concat(F.substring(value, 1, 4), like(F.substring(value, F.lit(5), F.length(value)), d)))
                 .when(kind == "account", F.concat(F.substring(value, 1, 2), like(F.substring(value, F.lit(3), F.length(value)), d)))
                 .when(kind == "secret", like(more("aa"), d)).otherwise(like(value, d)))


def split_match(e: Column, names: Column | None = None) -> Column:
    """What stays of a match, and the kinds and values of its parts to replace, as ``(stays, kind, values)``.

    ``names`` are those of the text, which a match of a single word is one of.
    """
    one = lambda kind: F.struct(F.lit("").alias("stays"), F.array(F.lit(kind)).alias("kinds"), F.array(e).alias("values"))
    before = F.regexp_extract(e, f"^({SECRET})", 1)
    secret = F.struct(before.alias("stays"), F.array(F.lit("secret")).alias("kinds"),
                      F.array(F.substring(e, F.length(before) + 1, F.length(e))).alias("values"))
    title = F.regexp_extract(e, f"^({ADDRESSED})", 1)
    parts = F.split(F.substring(e, F.length(title) + 1, F.length(e)), " ")
    called = lambda words: title.rlike(rf"(?<!\p{{L}})(?:{'|'.join(words)})[. ]")
    gender = F.when(called(FEMALE), "female").when(called(MALE), "male").otherwise("given")
    person = F.struct(title.alias("stays"), F.concat(
        F.array_repeat(gender, F.size(parts) - 1), F.array(F.lit("surname"))).alias("kinds"), parts.alias("values"))
    mention = one("surname") if names is None else F.struct(
        F.lit("").alias("stays"), F.array(F.element_at(F.filter(names, lambda n: n["value"] == e), -1)["kind"]).alias("kinds"),
        F.array(e).alias("values"))
    return (F.when(e.contains("@") & ~e.rlike(f"^{SECRET}"), one("email")).when(e.rlike(f"^{SECRET}"), secret)
            .when(e.rlike(f"^{ADDRESSED}") | e.rlike(f"^{NAMES}$"), person).when(e.rlike(f"^{NAME}$"), mention)
            .when(e.rlike(r"^(?:AKIA|ASIA|gh[pousr]_|sk-)"), one("key"))
            .when(e.rlike(r"^\d+\.\d+\.\d+\.\d+$"), one("ip")).when(e.rlike("^[A-Z]{2}"), one("account"))
            .when(e.rlike(r"^[+(]|^\d{3}-\d{3}-|^0\d{2,4}[ /-]\d{5,8}$"), one("phone")).when(e.rlike(r"^\d{3}-\d{2}-|:"), one("number"))
            .otherwise(one("card")))


def found_in(text: Column) -> Column:
    """All matches of a text in order."""
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).otherwise(
        F.array().cast("array<string>"))


def names_of(matches: Column) -> Column:
    """Distinct ``(value, kind)`` of the names among the matches of a text, by value."""
    people = F.filter(matches, lambda e: e.rlike(f"^{ADDRESSED}") | e.rlike(f"^{NAMES}$"))
    return F.array_sort(F.array_distinct(F.flatten(F.transform(people, lambda e: bound(split_match(e), lambda s: F.zip_with(
        s["values"], s["kinds"], lambda v, k: F.struct(v.alias("value"), k.alias("kind"))))))))


def any_of(words: Column) -> Column:
    """Pattern of any of the words, which have letters, apostrophes and hyphens only."""
    return F.concat(F.lit(r"(?<!\p{L})(?:"), F.array_join(F.array_distinct(words), "|"), F.lit(r")(?!\p{L})"))


def mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Distinct ``(id, th, kind, value)``: a document, the hash of its text, and a value to be replaced in it."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), found_in(F.col(text_col)).alias("e"))
    parts = rows.select("id", "th", F.explode("e").alias("e")).select("id", "th", split_match(F.col("e")).alias("s"))
    pairs = parts.select("id", "th", F.explode(F.arrays_zip("s.kinds", "s.values")).alias("p"))
    return pairs.select("id", "th", F.col("p.kinds").alias("kind"), F.col("p.values").alias("value")).distinct()


def dictionary(found: DataFrame, key: str) -> DataFrame:
    """``(kind, value, attempt, replacement)`` with all replacements distinct and unlike every value that occurs."""
    values = materialise(found.select("kind", "value").distinct())
    originals = values.select(F.col("value").alias("replacement")).distinct()
    settled, pending = None, values
    for attempt in range(ROUNDS):
        made = materialise(pending.select("kind", "value", F.lit(attempt).alias("attempt")).withColumn(
            "replacement", surrogate(F.col("kind"), F.col("value"), F.col("attempt"), key)))
        free = made.join(originals, "replacement", "left_anti")
        if settled is not None:
            free = free.join(settled.select("replacement"), "replacement", "left_anti")
        # of those that got the same replacement the first keeps it
        winners = free.groupBy("replacement").agg(F.min(F.struct("kind", "value", "attempt")).alias("w")).select("w.*", "replacement")
        winners = materialise(winners)
        settled = winners if settled is None else materialise(settled.unionByName(winners))
        pending = materialise(made.join(winners, ["kind", "value"], "left_anti").select("kind", "value"))
        if pending.isEmpty():
            return settled
    raise ValueError("some form has too few distinct surrogates for its values")


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in the text replaced; all columns and rows stay."""
    found = materialise(mentions(docs, id_col, text_col))
    again = dictionary(found, key).where("attempt > 0")
    own = materialise(found.join(again, ["kind", "value"]).groupBy("id", "th").agg(F.map_from_entries(F.collect_list(
        F.struct(F.concat_ws("\u0001", "kind", "value"), "replacement"))).alias("m")).select(
            F.struct("id", "th", "m").alias("_again")))
    text = docs[text_col]
    joined, replaced = docs, F.lit(None).cast("map<string,string>")
    size = own.agg(F.count("*"), F.sum(F.size("_again.m"))).first()
    if size[0]:  # few values need a second attempt
        small = own if size[0] * 64 + size[1] * 256 > BROADCAST_BYTES else F.broadcast(own)
        joined = docs.join(small, docs[id_col].eqNullSafe(F.col("_again.id")) & (F.xxhash64(text) == F.col("_again.th")), "left")
        replaced = F.col("_again.m")

    def render(e: Column, names: Column) -> Column:
        def part(kind, value):
            first = surrogate(kind, value, F.lit(0), key)
            return F.coalesce(F.try_element_at(replaced, F.concat_ws("\u0001", kind, value)), first) if size[0] else first
        return bound(split_match(e, names), lambda s: F.concat(s["stays"], F.array_join(
            F.zip_with(s["kinds"], s["values"], part), " ")))

    # worked out once per text, under names that no column of the input has
    matches, gaps, names, pattern = (f"_{what}_{uuid.uuid4().hex}" for what in ("matches", "gaps", "names", "pattern"))
    old, body = [F.col(f"`{c}`") for c in joined.columns], F.col(f"`{text_col}`")
    seen = joined.select(*old, found_in(text).alias(matches))
    seen = seen.select(*old, matches, names_of(F.col(matches)).alias(names))
    # further mentions, but of names that the text also has as a plain word beside its matches
    plain = F.regexp_extract_all(F.array_join(F.split(body, PATTERN, -1), " "), any_of(
        F.transform(names, lambda n: F.lower(n["value"]))), F.lit(0))
    seen = seen.select(*old, matches, F.when(F.size(names) > 0, bound(plain, lambda words: F.filter(
        names, lambda n: ~F.array_contains(words, F.lower(n["value"]))))).alias(names))
    seen = seen.select(*old, matches, names, F.when(F.size(names) > 0, F.concat(
        F.lit(f"{PATTERN}|"), any_of(F.transform(names, lambda n: n["value"])))).alias(pattern))
    known = F.col(pattern).isNotNull()
    cut = seen.select(
        *old, names, F.when(known, F.regexp_extract_all(body, F.col(pattern), F.lit(0))).otherwise(F.col(matches)).alias(matches),
        F.when(known, F.split(body, F.col(pattern), -1)).when(F.size(matches) > 0, F.split(body, PATTERN, -1)).alias(gaps))
    pieces = F.zip_with(F.col(gaps), F.transform(F.col(matches), lambda e: render(e, F.col(names))),
                        lambda gap, r: F.concat(gap, F.coalesce(r, F.lit(""))))
    changed = F.when(F.size(matches) > 0, F.array_join(pieces, "")).otherwise(body)
    return cut.select(*[changed.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
