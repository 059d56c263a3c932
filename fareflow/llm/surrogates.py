"""Personal data replaced by surrogates of the same type and format.

Detection: one pattern finds e-mail addresses, secrets (long hex strings, access keys), IPv4 addresses,
payment cards, social security and telephone numbers, and names of persons (after a title or beginning
with a known first name). Each kind has a canonical value, so that mentions written differently are one entity.

Surrogates: a keyed hash of kind and value draws the replacement, character by character within the same
class: digits for digits, letters for letters of the same script, vowels for vowels; no letter or digit stays because its
class is unknown. Cards keep their issuer's digits and a right check digit, numbers written with + their country code, addresses of one domain keep one domain, first names keep gender and script; case,
separators and country codes are those of each mention. Without the key, surrogates lead back to nobody.

Distinctness: a surrogate claimed by two entities goes to the smaller value, and none may be a value that occurs
in the texts itself; the losers draw again. So equal entities have equal surrogates in all documents and different
ones have different surrogates. Draws from the 16th on append digits, so there is always one left.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import free_name, text_key, written

EMAIL, SECRET, IP, CARD, SSN, PHONE = "email", "secret", "ip", "card", "ssn", "phone"
FEMALE, MALE, NEUTRAL, SURNAME = "first name, female", "first name, male", "first name", "surname"
KINDS = (EMAIL, SECRET, IP, CARD, SSN, PHONE, FEMALE, MALE, NEUTRAL, SURNAME)

FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Signora", "г-жа", "госпожа")
MALE_TITLES = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Signor", "г-н", "господин")
OTHER_TITLES = ("Dr", "Prof")
FEMALE_LATIN = ("Mary", "Anna", "Emma", "Laura", "Julia", "Sarah", "Maria", "Sophie", "Claire", "Elena", "Ingrid", "Carmen")
MALE_LATIN = ("John", "James", "Robert", "Thomas", "Daniel", "Peter", "Pablo", "Pierre", "Hans", "Carlos", "Martin", "Lucas")
FEMALE_CYRILLIC = ("Анна", "Мария", "Ольга", "Елена", "Ирина", "Наталья")
MALE_CYRILLIC = ("Иван", "Пётр", "Сергей", "Алексей", "Дмитрий", "Николай")
FEMALE_NAMES, MALE_NAMES = FEMALE_LATIN + FEMALE_CYRILLIC, MALE_LATIN + MALE_CYRILLIC

#: Characters are replaced within these classes, other letters within their span of code points; signs stay.
CLASSES = (
    "0123456789",
    "aeiouàáâäèéêëìíîïòóôöùúûü",
    "bcdfghjklmnpqrstvwxyzçñß",
    "аеёиоуыэюя",
    "бвгджзйклмнпрстфхцчшщ",
    "αεηιουωάέήίόύώ",
    "βγδζθκλμνξπρστφχψς",
)
#: How many characters of each class replacements are drawn from; accented ones give way to plain ones.
DRAWN = (10, 5, 20, 10, 21, 7, 17)
#: Spans of code points of scripts without case, or of their small letters: Han, Hangul, Hiragana, Katakana, Armenian, Georgian,
#: Hebrew, Arabic, Devanagari, Thai. Letters in neither class nor span (as ł or ґ) become a consonant of Latin or Cyrillic.
SPANS = (
    (0x4E00, 0x9FA5), (0xAC00, 0xD7A3), (0x3041, 0x3096), (0x30A1, 0x30FA), (0x0561, 0x0586), (0x10D0, 0x10F0),
    (0x05D0, 0x05EA), (0x0621, 0x063A), (0x0641, 0x064A), (0x0905, 0x0939), (0x0E01, 0x0E2E),
)
#: Country codes of telephone numbers that have one or two digits; the others have three.
SHORT_CODES = r"^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
#: Draws before replacements grow longer, and digits added each time.
DRAWS_IN_FORMAT = 16


def either(words: Sequence[str]) -> str:
    return "|".join([*words, *[w.upper() for w in words]])


OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
WORD = r"\p{Lu}[\p{L}'’-]++"
TITLES = either(FEMALE_TITLES + MALE_TITLES + OTHER_TITLES)
#: Every match begins where no letter or digit stands before it; ANY asks for that once.
PATTERNS = {
    EMAIL: r"(?<![._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+",
    SECRET: r"(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+|(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36,}+)(?![0-9A-Za-z])",
    IP: rf"(?<!\.){OCTET}(?:\.{OCTET}){{3}}(?![0-9]|\.[0-9])",
    CARD: r"(?:[0-9]{13,19}|[0-9]{4}(?: [0-9]{4}){3}|[0-9]{4}(?:-[0-9]{4}){3})(?![0-9A-Za-z])",
    SSN: r"(?<!-)[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    PHONE: r"(?<!\+)(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}"
    r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}(?:\.[0-9]{3}\.|-[0-9]{3}-)[0-9]{4})(?![0-9A-Za-z])",
    SURNAME: rf"(?:(?<=(?<!\p{{L}})(?:{TITLES})\.? ){WORD}(?: {WORD}){{0,2}}"
    rf"|(?:{either(FEMALE_NAMES + MALE_NAMES)})(?: {WORD}){{1,2}})",
}
#: The alternatives by the character they begin with, so that a position tries few of them.
BEGINS = {"[0-9]": (IP, CARD, SSN, PHONE), "[(+]": (PHONE,), "[0-9A-Ga-g]": (SECRET,), r"\p{Lu}": (SURNAME,)}
ANY = rf"(?<![\p{{L}}\p{{N}}])(?:{PATTERNS[EMAIL]}" + "".join(
    f"|(?={first})(?:{'|'.join(f'(?:{PATTERNS[k]})' for k in kinds)})" for first, kinds in BEGINS.items()
) + ")"
#: Set around matches while a text is cut; a text that holds it already is cut the long way.
MARK = "\ue000\ue001"


def digits_of(shown: Column) -> Column:
    return F.regexp_replace(shown, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Sum of the check rule over a string of digits; a valid number's ends in 0."""
    chars = F.split(F.reverse(digits), "")
    each = F.transform(chars, lambda c, i: c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1))
    return F.aggregate(each, F.lit(0), lambda a, d: a + F.when(d > 9, d - 9).otherwise(d))


def part(kind: Column, value: Column, shown: Column) -> Column:
    return F.struct(kind.alias("kind"), value.alias("value"), shown.alias("shown"))


def plain(shown: Column) -> Column:
    """A stretch of text that stays as it is."""
    none = F.lit(None).cast("string")
    return part(none, none, shown)


def name_parts(shown: Column, before: Column) -> Column:
    """A person's name as first names, a surname, and the spaces between."""
    words = F.regexp_extract_all(shown, F.lit(r"[^ ]+| +"), F.lit(0))
    titled = lambda titles: before.rlike(rf"(?<!\p{{L}})(?:{either(titles)})\.? $")
    own = [n.lower() for n in FEMALE_NAMES], [n.lower() for n in MALE_NAMES]

    def one(word: Column, i: Column) -> Column:
        low = F.lower(word)
        first = (
            F.when(low.isin(own[0]), FEMALE)
            .when(low.isin(own[1]), MALE)
            .when(titled(FEMALE_TITLES), FEMALE)
            .when(titled(MALE_TITLES), MALE)
            .otherwise(NEUTRAL)
        )
        last = (i == F.size(words) - 1) & ~((F.size(words) == 1) & low.isin([*own[0], *own[1]]))
        return F.when(word.startswith(" "), plain(word)).otherwise(part(F.when(last, SURNAME).otherwise(first), low, word))

    return F.transform(words, one)


def mention_parts(shown: Column, before: Column) -> Column:
    """The parts of one match of ANY; a number that fails the cards' check digit is no card."""
    digits = digits_of(shown)
    is_ = {kind: shown.rlike(f"^(?:{PATTERNS[kind]})$") for kind in (EMAIL, SECRET, IP, CARD, SSN, PHONE)}
    long = (F.length(digits) == 11) & digits.startswith("1")
    hexadecimal = shown.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")
    card = F.array(F.when(luhn(digits) % 10 == 0, part(F.lit(CARD), digits, shown)).otherwise(plain(shown)))
    return (
        F.when(is_[EMAIL], F.array(part(F.lit(EMAIL), F.lower(shown), shown)))
        .when(is_[CARD], card)
        .when(is_[SECRET], F.array(part(F.lit(SECRET), F.when(hexadecimal, F.lower(shown)).otherwise(shown), shown)))
        .when(is_[IP], F.array(part(F.lit(IP), shown, shown)))
        .when(is_[SSN], F.array(part(F.lit(SSN), digits, shown)))
        .when(is_[PHONE], F.array(part(F.lit(PHONE), F.when(long, F.substring(digits, 2, 10)).when(shown.startswith("+"), F.concat(F.lit("+"), digits)).otherwise(digits), shown)))
        .otherwise(name_parts(shown, before))
    )


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_parts(text: str) -> Column:
    """A whole text as stretches that stay and entities, in order."""
    marked = F.split(F.regexp_replace(text, ANY, f"{MARK}$0{MARK}"), MARK, -1)
    pieces, mentions = F.split(text, ANY, -1), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    paired = bound(mentions, lambda m: F.flatten(F.transform(pieces, lambda p, i: F.array(p, F.get(m, i)))))
    long_way = F.slice(paired, F.lit(1), F.size(mentions) * 2 + 1)

    def cut(turns: Column) -> Column:
        """Stretches and matches take turns."""

        def one(piece: Column, i: Column) -> Column:
            return F.when(i % 2 == 0, F.array(plain(piece))).otherwise(mention_parts(piece, F.get(turns, i - 1)))

        return F.flatten(F.transform(turns, one))

    return bound(F.when(F.instr(text, MARK) > 0, long_way).otherwise(marked), cut)


Draw = Callable[[Column | int], Column]


def drawing(key: str, what: Sequence[Column], body: Callable[[Draw], Column]) -> Column:
    """``body`` with numbers from 0 up for positions 0, 1, …: a keyed hash of ``what``, its 32 bytes over and over.

    Each round adds one, so that a repeated character does not show the period.
    """
    digest = F.sha2(F.concat_ws("\x1f", F.lit(key), *what), 256)
    numbers = bound(
        digest,
        lambda d: F.transform(
            F.sequence(F.lit(0), F.lit(31)), lambda i: F.conv(F.substring(d, 2 * i + 1, F.lit(2)), 16, 10).cast("int")
        ),
    )

    def draws(known: Column) -> Draw:
        return lambda i: F.get(known, (F.lit(i) if isinstance(i, int) else i) % 32) + F.floor(i / 32 if not isinstance(i, int) else F.lit(i // 32)).cast("int")

    return bound(numbers, lambda known: body(draws(known)))


def redrawn(chars: Column, drawn: Draw) -> Column:
    """A string, each character replaced by another of its class and case."""

    def one(c: Column, i: Column) -> Column:
        def pick(low: Column, n: Column) -> Column:
            code = F.ascii(low)
            latin, cyrillic = (F.substring(F.lit(CLASSES[k]), n % DRAWN[k] + 1, F.lit(1)) for k in (2, 4))
            spans = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b - a).alias("wide")) for a, b in SPANS])
            own = F.get(F.filter(spans, lambda s: code.between(s["a"], s["a"] + s["wide"])), F.lit(0))
            moved = lambda s: s["a"] + (code - s["a"] + 1 + n % s["wide"]) % (s["wide"] + 1)
            letter = bound(own, lambda s: F.decode(F.unhex(F.lpad(F.hex(moved(s)), 4, "0")), "UTF-16BE"))
            choice = F.coalesce(letter, F.when(low.rlike(r"\p{IsCyrillic}"), cyrillic).when(low.rlike(r"[\p{L}\p{N}]"), latin))
            for letters, size in reversed(list(zip(CLASSES, DRAWN, strict=True))):
                found = F.substring(F.lit(letters), n % size + 1, F.lit(1))
                choice = F.when(F.instr(F.lit(letters), low) > 0, found).otherwise(choice)
            return F.coalesce(F.when(low != c, F.upper(choice)).otherwise(choice), c)

        return bound(F.struct(F.lower(c).alias("low"), drawn(i).alias("n")), lambda x: pick(x["low"], x["n"]))

    return F.array_join(F.transform(F.split(chars, ""), one), "")


def hex_redrawn(chars: Column, drawn: Draw) -> Column:
    def one(c: Column, i: Column) -> Column:
        letter = F.substring(F.lit("abcdef"), drawn(i) % 6 + 1, F.lit(1))
        return F.when(c.rlike("[0-9]"), (drawn(i) % 10).cast("string")).otherwise(letter)

    return F.array_join(F.transform(F.split(chars, ""), one), "")


def extension(more: Column, drawn: Draw, of: str) -> Column:
    """``more`` characters drawn from ``of``, for draws that outgrow the format."""
    one = lambda i: F.when(i > 0, F.substring(F.lit(of), drawn(i + 7) % len(of) + 1, F.lit(1))).otherwise("")
    return F.array_join(F.transform(F.sequence(F.lit(0), more), one), "")


def card_number(value: Column, more: Column, drawn: Draw) -> Column:
    """Another card number: the issuer's two digits stay, and the last one is set so that the check rule holds."""

    def checked(body: Column) -> Column:
        check = (10 - luhn(F.concat(body, F.lit("0"))) % 10) % 10
        return F.concat(body, check.cast("string"))

    rest = F.concat(F.substring(value, 1, 2), redrawn(F.substring(value, 3, 99), drawn), extension(more, drawn, CLASSES[0]))
    return bound(bound(rest, lambda r: F.substring(r, F.lit(1), F.length(r) - 1)), checked)


def telephone_number(value: Column, drawn: Draw) -> Column:
    """Another number of the same country; ``value`` begins with + and the country's code."""
    digits = F.substring(value, 2, 99)
    code = F.when(digits.rlike(SHORT_CODES), F.regexp_extract(digits, SHORT_CODES, 0)).otherwise(F.substring(digits, 1, 3))
    rest = bound(F.substr(digits, F.length(code) + 1), lambda r: redrawn(r, drawn))
    return F.concat(F.lit("+"), code, rest)


def email_address(value: Column, more: Column, drawn: Draw, key: str) -> Column:
    """Another address. Its domain follows from the old domain alone, in a name space that nobody owns."""
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    last = F.substring_index(domain, ".", -1)
    ending = F.when(last.isin("com", "net", "org"), F.concat(F.lit(".example."), last)).otherwise(".example")
    label = drawing(key, [F.lit("domain"), domain], lambda of_domain: redrawn(F.substring_index(domain, ".", 1), of_domain))
    return F.concat(redrawn(local, drawn), extension(more, drawn, CLASSES[0]), F.lit("@"), label, ending)


def ip_address(more: Column, drawn: Draw) -> Column:
    octet = lambda i: (1 + (drawn(2 * i) * 256 + drawn(2 * i + 1)) % 254).cast("string")
    port = F.when(more > 0, F.concat(F.lit(":"), extension(more, drawn, CLASSES[0]))).otherwise("")
    return F.concat(F.concat_ws(".", *map(octet, range(4))), port)


def first_name(kind: Column, value: Column, attempt: Column, drawn: Draw) -> Column:
    """A listed name of the same gender and script; later draws make a name up in the old one's letters."""
    listed = lambda names: F.array(*[F.lit(n.lower()) for n in names])
    cyrillic = value.rlike(r"^\p{IsCyrillic}")
    names = (
        F.when((kind == FEMALE) & cyrillic, listed(FEMALE_CYRILLIC))
        .when((kind == MALE) & cyrillic, listed(MALE_CYRILLIC))
        .when(cyrillic, listed(FEMALE_CYRILLIC + MALE_CYRILLIC))
        .when(kind == FEMALE, listed(FEMALE_LATIN))
        .when(kind == MALE, listed(MALE_LATIN))
        .otherwise(listed(FEMALE_LATIN + MALE_LATIN))
    )
    from_list = bound(names, lambda n: F.get(n, (drawn(0) * 256 + drawn(1)) % F.size(n)))
    return F.when((attempt < 3) & value.rlike(r"^[\p{IsLatin}\p{IsCyrillic}]"), from_list).otherwise(redrawn(value, drawn))


def surrogate(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """The replacement's canonical value, as drawn at an attempt."""

    def made(drawn: Draw) -> Column:
        more = F.greatest(F.lit(0), attempt - (DRAWS_IN_FORMAT - 1)).cast("int")
        secret = F.when(value.rlike("^[0-9a-f]+$"), hex_redrawn(value, drawn)).otherwise(
            F.concat(F.substring(value, 1, 4), redrawn(F.substring(value, 5, 9999), drawn))
        )
        name = F.when(kind == SURNAME, redrawn(value, drawn)).otherwise(first_name(kind, value, attempt, drawn))
        return (
            F.when(kind == EMAIL, email_address(value, more, drawn, key))
            .when(kind == CARD, card_number(value, more, drawn))
            .when(kind == IP, ip_address(more, drawn))
            .when(kind == SECRET, F.concat(secret, extension(more, drawn, CLASSES[0])))
            .when((kind == PHONE) & value.startswith("+"), F.concat(telephone_number(value, drawn), extension(more, drawn, CLASSES[0])))
            .when(kind.isin(SSN, PHONE), F.concat(redrawn(value, drawn), extension(more, drawn, CLASSES[0])))
            .otherwise(F.concat(name, extension(more, drawn, "aeiou")))
        )

    return drawing(key, [kind, value, attempt.cast("string")], made)


def rendered(kind: Column, made: Column, shown: Column) -> Column:
    """A replacement in the format of one mention: its separators, country code and case."""

    def spaced(digits: Column) -> Column:
        gaps = F.split(shown, "[0-9]", -1)
        put = F.transform(gaps, lambda g, i: F.concat(g, F.substring(digits, i + 1, F.lit(1))))
        return F.concat(F.array_join(put, ""), F.substring(digits, F.size(gaps) + 1, F.lit(9999)))

    def shaped(found: Column) -> Column:
        old = digits_of(shown)
        kept = F.substring(old, F.lit(1), F.greatest(F.lit(0), F.length(old) - F.length(digits_of(found))))
        cased = (
            F.when((shown == F.upper(shown)) & (shown != F.lower(shown)) & (F.length(shown) > 1), F.upper(found))
            .when(F.substring(shown, 1, 1) != F.lower(F.substring(shown, 1, 1)), F.initcap(found))
            .otherwise(found)
        )
        as_is = (kind == SECRET) & ~found.rlike("^[0-9a-f]+$")
        return F.when(kind.isin(CARD, SSN, PHONE), spaced(F.concat(kept, digits_of(found)))).when(as_is, found).otherwise(cased)

    return bound(made, shaped)


def assign(entities: DataFrame, key: str) -> DataFrame:
    """Entities whose first draw is taken: kind, value, attempt (1 or more).

    Round k judges draw k of the entities that still have none. ``entities``: kind, value; each once.
    """
    taken = entities.select("kind", F.col("value").alias("found"))
    open_, settled, attempt = entities, [], 0
    while True:
        drawn = surrogate(F.col("kind"), F.col("value"), F.lit(attempt), key)
        claims = open_.withColumn("found", drawn)
        free = claims.join(taken, ["kind", "found"], "left_anti")
        won = written(free.groupBy("kind", "found").agg(F.min("value").alias("value")), "surrogates")
        settled.append(won.select("kind", "value", F.lit(attempt).alias("attempt")))
        open_ = written(open_.join(won, ["kind", "value"], "left_anti"), "surrogates-open")
        if open_.isEmpty():
            break
        taken, attempt = taken.union(won.select("kind", "found")), attempt + 1
    out = settled[0].where("false")
    for later in settled[1:]:
        out = out.union(later)
    return out


def with_surrogates(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with each entity in ``text_col`` replaced, and ``entities``: how many of each kind (a map).

    A null text stays null and an empty one empty, with no entities. Texts without an entity come out as they are,
    repeated rows alike. Texts are never shuffled: the mentions are, without their
    surroundings, and the few entities whose first draw was taken come back as one row a document.
    A column named ``entities`` is replaced.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() == "entities" and c not in (id_col, text_col)])
    hash_, parts, again, redo_id, redo_key = free_name(docs, ["_key", "_parts", "_again", "_redo_id", "_redo_key"])
    own = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("key"), F.col(text_col).alias("text"))
    each = own.select("id", "key", F.explode(F.filter(text_parts("text"), lambda p: p["kind"].isNotNull())).alias("p"))
    mentions = written(each.select("id", "key", "p.kind", "p.value"), "mentions")
    entities = written(mentions.select("kind", "value").distinct(), "entities")
    redraw = written(assign(entities, key), "redrawn")
    redo = mentions.join(redraw, ["kind", "value"]).groupBy("id", "key").agg(
        F.collect_set(F.struct("kind", "value", "attempt")).alias(again)
    )
    redo = written(redo.withColumnsRenamed({"id": redo_id, "key": redo_key}), "redrawn-documents")

    read = docs.withColumns({hash_: text_key(text_col), parts: text_parts(text_col)})
    same = F.col(id_col).eqNullSafe(F.col(redo_id)) & (F.col(hash_) == F.col(redo_key))

    def new(p: Column) -> Column:
        of = F.filter(again, lambda a: (a["kind"] == p["kind"]) & (a["value"] == p["value"]))
        attempt = F.coalesce(F.get(of, F.lit(0))["attempt"], F.lit(0))
        made = rendered(p["kind"], surrogate(p["kind"], p["value"], attempt, key), p["shown"])
        return F.when(p["kind"].isNull(), p["shown"]).otherwise(made)

    count = lambda kind: F.size(F.filter(parts, lambda p: p["kind"] == kind))
    counts = F.create_map(*[x for kind in KINDS for x in (F.lit(kind), F.when(F.col(text_col).isNull(), 0).otherwise(count(kind)))])
    return (
        read.join(redo, same, "left")
        .withColumns({"entities": F.map_filter(counts, lambda _, n: n > 0), text_col: F.array_join(F.transform(parts, new), "")})
        .select(*docs.columns, "entities")
    )
