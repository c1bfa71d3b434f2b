"""Surrogates for personal data.

Entities (addresses, telephone, card and account numbers, network addresses, secrets, titled names) are found by pattern
and replaced by surrogates of the same type and format. A surrogate is a keyed permutation (a Feistel network) of the
entity's characters within their class: digits stay digits, letters keep script and case, separators stay where they
are, a valid card or account number gets valid check digits, a name gets a given name of the same gender and script. As it
depends on the key and the entity's normal form only, the same entity gets the same surrogate in every document (numbers in
any layout, addresses and names in any case), with no table of entities to ship.

Permutations keep different entities apart within one layout. What they cannot exclude is checked over the distinct
entities of the whole corpus: two entities with one surrogate, or a surrogate that is itself an entity of the corpus.
Those get the permutation of the next attempt until the check is clean. A name first tries every given name of its list with
its surname kept, then other surnames. What is left after 32 attempts is numbered within its colliding group, and the number
makes surrogates longer where the type allows it (names, addresses, secrets, telephone numbers). There is no last attempt.
These exceptions are joined to the documents that hold such an entity; the join is by text digest, and Spark chooses it by
measured size.

Null texts stay null, empty ones empty. Texts are read whole. Repeated rows get equal results; missing ids are kept; an empty
table gives an empty result. All columns of the input are kept; helper columns take names that do not clash.
"""

from __future__ import annotations

import functools
import hashlib
import ipaddress
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltide.llm.tables import free_name
from voltide.session import stage

ROUNDS = 8
ATTEMPTS = 32
REMEMBERED = 50_000
# How many social security numbers and network addresses there are.
ROOM = {"ssn": 10**9, "ip": 2**32}

# Titles by gender, and common given names by gender and script.
MALE = ("Mr", "Mister", "Herr", "Señor", "Sr", "Monsieur", "господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "госпожа")
NEUTRAL = ("Dr", "Prof")
GIVEN = {
    ("m", "latin"): "James John Robert Peter Paul Martin Daniel Thomas Lucas Simon Victor Oscar Hugo Felix Anton".split(),
    ("f", "latin"): "Mary Anna Laura Julia Clara Emma Sarah Nina Helen Alice Maria Sofia Lucia Eva Irene".split(),
    ("n", "latin"): "Alex Robin Kim Sascha Noel Jean Dominique Chris Jamie Andrea".split(),
    ("m", "cyrillic"): "Иван Пётр Павел Сергей Андрей Олег Юрий Борис".split(),
    ("f", "cyrillic"): "Анна Мария Ольга Елена Ирина Вера Нина Юлия".split(),
    ("n", "cyrillic"): "Саша Женя Валя".split(),
}

PARTICLES = "van von der den de del della di da do dos das du la le zu af av ten ter bin ibn".split()


def _capitals() -> str:
    """The upper-case letters as ranges of a character class."""
    codes = [n for n in range(0x20000) if chr(n).isupper() and chr(n).isalpha()]
    firsts = [n for k, n in enumerate(codes) if not k or codes[k - 1] != n - 1]
    lasts = [n for k, n in enumerate(codes) if k + 1 == len(codes) or codes[k + 1] != n + 1]
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(firsts, lasts, strict=True))


_TITLE = "|".join((*MALE, *FEMALE, *NEUTRAL))
_LETTER, _CAPITAL = r"[^\W\d_]", f"[{_capitals()}]"
# Letters with single apostrophes and hyphens between them; a possessive s is not part of a name.
_REST = rf"(?:(?:-|['’](?![sS](?!\w)))?{_LETTER})+"
_WORD = rf"(?:(?:[dlDL]['’]|(?:al|el|an|ar|as|ad|ash)-)?{_CAPITAL}{_REST})"
# Initials and particles stand before a capitalised word.
_BEFORE = rf"(?:(?:{'|'.join(PARTICLES)})[ ]|{_CAPITAL}\.-?[ ]?|{_CAPITAL}[ ])*"
# Every capitalised word that follows; a name that does not begin with one has two words at most.
_WHO = rf"{_BEFORE}{_WORD}(?:[ ]{_BEFORE}{_WORD})*|{_LETTER}{_REST}(?:[ ]{_LETTER}{_REST})?"
ENTITY = re.compile(
    "|".join(
        (
            r"(?P<secret>(?<=[=:])\s?[\"']?[A-Za-z0-9_+/-]{16,}|(?<![\w])[0-9a-fA-F]{32,}(?![\w]))",
            r"(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?:\s?[A-Z0-9]{4}){3,7}(?:\s?[A-Z0-9]{1,3})?(?!\w))",
            r"(?P<ip>(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d))",
            r"(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))",
            r"(?P<card>(?<![\w-])(?:\d{13,19}|\d{4}(?P<gap>[ -])\d{4}(?P=gap)\d{4}(?P=gap)\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})"
            r"(?![\w-]))",
            r"(?P<phone>\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\w)"
            r"|(?<!\w)\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\w)|(?<![\w-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-]))",
            rf"(?P<name>(?<!\w)(?P<title>{_TITLE})(?P<dot>\.?\s+)(?=[^\W\d_])(?P<who>{_WHO}))",
        )
    )
)
# E-mail addresses are found from their sign outwards, so that long runs of word characters are read once.
LOCAL = re.compile(r"[\w.%+-]*")
LOCAL_FIRST = re.compile(r"\w")
DOMAIN = re.compile(r"[^\W_][\w-]*+(?:\.[\w-]++)*\.[^\W\d_]{2,}")
KINDS = ("email", "secret", "iban", "ip", "ssn", "card", "phone", "name")
# A cheap look whether a text can hold an entity at all: a digit, an at sign, or a title.
HINT = re.compile(rf"[\d@]|(?<!\w)(?:{_TITLE})\.?\s")

# Ranges of lower-case or uncased letters that are permuted among themselves.
SCRIPTS = [
    ("a", "z"), ("à", "ö"), ("ø", "ÿ"), ("α", "ω"), ("а", "я"), ("א", "ת"), ("ぁ", "ゖ"), ("ァ", "ヺ"),
    ("一", "龥"), ("가", "힣"),
]
TWO_DIGIT_COUNTRIES = set(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 "
    "90 91 92 93 94 95 98".split()
)
VOWELS, CONSONANTS, HEX = "aeiou", "bcdfghjklmnpqrstvwxyz", "0123456789abcdef"


def _prf(key: bytes, tweak: str, turn: int, value: int) -> int:
    message = f"{tweak}\x00{turn}\x00{value}".encode()
    return int.from_bytes(hashlib.blake2b(message, key=key, digest_size=32).digest(), "big")


def permute(numbers: list[int], radix: int, tweak: str, key: bytes) -> list[int]:
    """A keyed permutation of the sequences of this length over ``radix`` symbols."""
    n = len(numbers)
    if n == 0:
        return []
    if n == 1:
        return [(numbers[0] + _prf(key, f"{tweak}/{radix}", 0, 0)) % radix]
    half = n // 2
    sizes = radix**half, radix ** (n - half)

    def joined(part: list[int]) -> int:
        total = 0
        for number in part:
            total = total * radix + number
        return total

    def split(value: int, size: int) -> list[int]:
        out = []
        for _ in range(size):
            value, rest = divmod(value, radix)
            out.append(rest)
        return out[::-1]

    halves = [joined(numbers[:half]), joined(numbers[half:])]
    for turn in range(ROUNDS):
        side = turn % 2
        halves[side] = (halves[side] + _prf(key, f"{tweak}/{radix}/{n}", turn, halves[1 - side])) % sizes[side]
    return split(halves[0], half) + split(halves[1], n - half)


def _classes(text: str, alphabets: list[str] | None) -> list[tuple[str, int, int] | None]:
    """For each character its class, radix and number in it; None for characters that stay."""
    found: list[tuple[str, int, int] | None] = []
    for c in text:
        low = c.lower() if len(c.lower()) == 1 else c
        here = None
        if alphabets:
            for letters in alphabets:
                if low in letters:
                    here = (letters, len(letters), letters.index(low))
                    break
        if here is None and "0" <= c <= "9":
            here = ("0", 10, ord(c) - 48)
        elif here is None:
            for first, last in SCRIPTS:
                if first <= low <= last:
                    here = (first, ord(last) - ord(first) + 1, ord(low) - ord(first))
                    break
        found.append(here)
    return found


def reformat(text: str, tweak: str, key: bytes, alphabets: list[str] | None = None) -> str:
    """Permute the characters of each class among the places of that class; case and other characters stay."""
    classes = _classes(text, alphabets)
    layout = "".join(c[0][0] if c else text[i].lower() for i, c in enumerate(classes))
    out, shouted = list(text), text.isupper()
    for kind in sorted({c[0] for c in classes if c}):
        places = [i for i, c in enumerate(classes) if c and c[0] == kind]
        radix = classes[places[0]][1]
        moved = permute([classes[i][2] for i in places], radix, f"{tweak}/{layout}/{kind[0]}", key)
        for i, number in zip(places, moved, strict=True):
            letter = kind[number] if len(kind) > 1 else chr(ord(kind) + number)
            capital = shouted if kind == HEX else text[i] != text[i].lower()
            out[i] = letter.upper() if capital and letter.upper().lower() == letter else letter
    return "".join(out)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _laid_out(digits: str, like: str) -> str:
    rest = iter(digits)
    return "".join(next(rest) if "0" <= c <= "9" else c for c in like)


def _iban_check(country: str, body: str) -> str:
    value = "".join(str(int(c, 36)) for c in body + country + "00")
    return f"{98 - int(value) % 97:02d}"


def gender_of(title: str, who: str) -> str:
    """By the title, else by a given name that is on one list only."""
    if title in MALE or title in FEMALE:
        return "m" if title in MALE else "f"
    given = re.split("[ -]", who)[0].capitalize()
    return next((g for (g, _), names in GIVEN.items() if g != "n" and given in names), "n") if " " in who else "n"


def lowered(text: str) -> str:
    """Lower case letter by letter, as ``reformat`` sees it; letters whose lower case is longer stay."""
    return "".join(low if len(low := c.lower()) == 1 else c for c in text)


def normal_form(kind: str, text: str) -> str:
    """What makes two mentions the same entity. Surrogates are made from it and laid out like the mention."""
    if kind in ("card", "ssn"):
        return _digits(text)
    if kind == "phone":
        return "+" * text.startswith("+") + _digits(text)
    if kind == "iban":
        return re.sub(r"\s", "", text)
    if kind == "ip":
        return ".".join(str(int(part)) for part in text.split("."))
    return lowered(text.replace("’", "'") if kind == "name" else text)


def _card(text: str, tweak: str, key: bytes) -> str:
    digits = _digits(text)
    valid = luhn(digits)
    if valid:
        head = "".join(map(str, permute([int(c) for c in digits[:-1]], 10, f"{tweak}/luhn", key)))
        return _laid_out(next(head + d for d in "0123456789" if luhn(head + d)), text)
    while True:  # numbers without a valid check digit are permuted among themselves
        digits = "".join(map(str, permute([int(c) for c in digits], 10, tweak, key)))
        if not luhn(digits):
            return _laid_out(digits, text)


def _ssn(text: str, tweak: str, key: bytes) -> str:
    moved = permute([int(c) for c in _digits(text)], 10, tweak, key)
    return _laid_out("".join(map(str, moved)), text)


def _country(digits: str) -> str:
    """The country code that an international number begins with; no code begins with another."""
    size = 1 if digits[:1] in ("1", "7") else 2 if digits[:2] in TWO_DIGIT_COUNTRIES else 3
    return digits[:size]


def _phone(text: str, tweak: str, key: bytes) -> str:
    digits = _digits(text)
    kept = len(_country(digits)) if text.startswith("+") else 0
    moved = permute([int(c) for c in digits[kept:]], 10, f"{tweak}/{digits[:kept]}", key)
    return _laid_out(digits[:kept] + "".join(map(str, moved)), text)


def _ip(text: str, tweak: str, key: bytes, attempt: int) -> str:
    octets = [int(part) for part in text.split(".")]
    if attempt >= ATTEMPTS:  # out of few numbers of its layout into all addresses
        octets, tweak = [part % 256 for part in octets], f"{tweak}/{normal_form('ip', text)}"
    if max(octets) > 255:
        return reformat(normal_form("ip", text), tweak, key)
    return str(ipaddress.IPv4Address(bytes(permute(octets, 256, tweak, key))))


def _tail(attempt: int, like: str) -> str:
    """Nothing for the first attempts, then letters that spell the attempt in the script and case of ``like``."""
    number, out = attempt - ATTEMPTS, ""
    first, radix = next(((c[0], c[1]) for c in reversed(_classes(like, None)) if c and c[0] != "0"), ("a", 26))
    while number >= 0:
        number, letter = number // radix - 1, chr(ord(first) + number % radix)
        out = (letter.upper() if like.isupper() and letter.upper().lower() == letter else letter) + out
    return out


def _email(text: str, tweak: str, key: bytes, attempt: int) -> str:
    local, _, domain = text.rpartition("@")
    labels, _, top = domain.rpartition(".")
    return f"{reformat(local, f'{tweak}/local', key)}{_tail(attempt, local)}@{reformat(labels, f'{tweak}/domain', key)}.{top}"


def _iban(text: str, tweak: str, key: bytes) -> str:
    plain = normal_form("iban", text)
    body = reformat(plain[4:], f"{tweak}/{plain[:2]}", key)
    whole = iter(plain[:2] + _iban_check(plain[:2], body) + body)
    return "".join(c if c.isspace() else next(whole) for c in text)


def _part(word: str, tweak: str, key: bytes, alphabets: list[str] | None = None) -> str:
    """One word of a name; both apostrophes count as one and stay as they are."""
    moved = reformat(word.replace("’", "'"), tweak, key, alphabets)
    return "".join(old if old == "’" else new for old, new in zip(word, moved, strict=True))


def _given_names(gender: str, word: str) -> list[str] | None:
    """The list that a given name's surrogate comes from; None for initials, particles and other scripts."""
    low = word[0].lower()
    script = "cyrillic" if "а" <= low <= "я" or low == "ё" else "latin"
    listed = "a" <= low <= "z" or "à" <= low <= "ÿ" or script == "cyrillic"
    if not listed or len(word) == 1 or "." in word or word.lower() in PARTICLES:
        return None
    return GIVEN[gender, script]


def _name(text: str, tweak: str, key: bytes, attempt: int) -> str:
    """``text`` is gender, bar, name: the last word is the surname, the first of several the given name."""
    gender, _, name = text.partition("|")
    words = name.split(" ")
    choices = _given_names(gender, words[0]) if len(words) > 1 else None
    # The surname does not depend on the given name, nor on the attempt while there is a given name to change.
    changes = len(choices) if choices else 1
    surname_tweak = "surname" if attempt < changes else f"{tweak}/{normal_form('name', ' '.join(words[:-1]))}"
    surname = _part(words[-1], surname_tweak, key, [VOWELS, CONSONANTS]) + _tail(attempt, words[-1])
    if len(words) == 1:
        return f"{gender}|{surname}"
    if choices:
        number = _prf(key, "given", 0, int.from_bytes(normal_form("name", words[0]).encode(), "big")) + attempt
        given = choices[number % len(choices)]
        given = given if words[0] != words[0].upper() else given.upper()
    else:
        given = _part(words[0], tweak, key)
    middle = [_part(word, f"{tweak}/{k}", key, [VOWELS, CONSONANTS]) for k, word in enumerate(words[1:-1])]
    return f"{gender}|{' '.join([given, *middle, surname])}"


def surrogate(kind: str, text: str, key: bytes, attempt: int = 0) -> str:
    """The replacement of one mention (for names: gender, bar, name)."""
    tweak = f"{kind}/{attempt}" if attempt else kind
    if kind == "name":
        return _name(text, tweak, key, attempt)
    more = str(attempt - ATTEMPTS) if attempt >= ATTEMPTS and kind in ("secret", "phone") else ""
    if kind == "secret":
        # The letters decide between hexadecimal and any, not their case.
        return reformat(text, tweak, key, [HEX] if re.fullmatch(r"[\s\"']*[0-9a-fA-F]+", text) else None) + more
    if kind in ("ip", "email"):
        return {"ip": _ip, "email": _email}[kind](text, tweak, key, attempt)
    return {"card": _card, "phone": _phone, "iban": _iban, "ssn": _ssn}[kind](text, tweak, key) + more


def _addresses(text: str) -> Iterator[tuple[int, int, int]]:
    """(earliest start, place of the sign, end) of the e-mail addresses of a text."""
    last, at = 0, text.find("@")
    while at >= 0:
        before, domain = LOCAL.match(text[last:at][::-1]).end(), DOMAIN.match(text, at + 1)
        if before and domain:
            yield at - before, at, domain.end()
        last, at = at + 1, text.find("@", at + 1)


def _entities(text: str) -> Iterator[tuple[int, int, re.Match | None]]:
    """(start, end, match) of what does not overlap, leftmost first; an e-mail address has no match and goes first."""
    place, found, addresses = 0, ENTITY.search(text), _addresses(text)
    address = next(addresses, None)
    while found or address:
        if address:
            low, sign, end = address
            first = LOCAL_FIRST.search(text, max(low, place), sign) if place < sign else None
            if not first:
                address = next(addresses, None)
                continue
            if not found or first.start() <= found.start():
                yield first.start(), end, None
                place, address = end, next(addresses, None)
                if found and found.start() < place:
                    found = ENTITY.search(text, place)
                continue
            address = first.start(), sign, end
        yield *found.span(), found
        place = found.end()
        found = ENTITY.search(text, place)


def mentions(text: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, kind, mention) of the entities of a text, in order; for names the title stays outside."""
    if not HINT.search(text):
        return
    for start, end, found in _entities(text):
        if found is None:
            yield start, end, "email", text[start:end]
            continue
        kind = next(k for k in KINDS if k != "email" and found[k] is not None)
        if kind == "name":
            start, end = found.span("who")
            yield start, end, kind, f"{gender_of(found['title'], found['who'])}|{found['who']}"
        elif kind == "secret":
            value = re.search(r"[A-Za-z0-9_+/-]+$", found.group())
            if any(c.isdigit() for c in value.group()):
                yield start + value.start(), end, kind, value.group()
        else:
            yield start, end, kind, found.group()


def replace(text: str, key: bytes, attempts: dict[tuple[str, str], int], known) -> tuple[str, int]:
    """The text with surrogates, and how many mentions were replaced."""
    out, at, n = [], 0, 0
    for start, end, kind, mention in mentions(text):
        attempt = attempts.get((kind, normal_form(kind, mention)), 0) if attempts else 0
        new = known(kind, mention, key, attempt)
        out += text[at:start], new.partition("|")[2] if kind == "name" else new
        at, n = end, n + 1
    return ("".join([*out, text[at:]]), n) if n else (text, 0)


_ENTITIES = "kind string, normal string"


def find_entities(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per distinct (kind, normal form) of a row, with the columns ``keep``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, kinds, normals = [], [], []
            for row, value in enumerate(batch.column(0)):
                found = {(kind, normal_form(kind, m)) for *_, kind, m in mentions(value.as_py() or "")}
                for kind, normal in sorted(found):
                    at.append(row)
                    kinds.append(kind)
                    normals.append(normal)
            kept = [batch.column(1 + k).take(pa.array(at, pa.int64())) for k in range(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(kinds, pa.string()), pa.array(normals, pa.string())],
                names=[*keep, "kind", "normal"],
            )

    read = docs.select(F.col(text).cast("string"), *keep)
    schema = ", ".join([*(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep), _ENTITIES])
    return read.mapInArrow(run, schema)


def assign(entities: DataFrame, key: bytes, attempt: int | None = None) -> DataFrame:
    """Distinct entities (kind, normal) with the normal form of their surrogate in this attempt, else in their column ``attempt``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(column.to_pylist() for column in batch.columns), strict=True)
            made = [normal_form(k, surrogate(k, m, key, n)) for k, m, n in rows]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(made, pa.string())], names=["kind", "normal", "attempt", "made"]
            )

    turn = F.col("attempt") if attempt is None else F.lit(attempt).alias("attempt")
    made = entities.select("kind", "normal", turn).mapInArrow(run, f"{_ENTITIES}, attempt int, made string")
    return made.select("kind", "normal", "made", "attempt")


def exceptions(docs: DataFrame, key: bytes, text: str = "text", first_made=assign) -> DataFrame | None:
    """(kind, normal, attempt) of the entities whose first surrogate would not be theirs alone; None without any.

    A round looks only at what the rounds before left open. Settled surrogates stay with their entities.
    """
    entities = stage(find_entities(docs, text).distinct(), "entities")
    real = entities.select("kind", F.col("normal").alias("made"))
    fresh, settled, turn = stage(first_made(entities, key, 0), "surrogates"), [], 0
    while True:
        first = fresh.groupBy("kind", "made").agg(F.min("normal").alias("owner"), F.count(F.lit(1)).alias("n"))
        shared = first.filter("n > 1").select("kind", "made", "owner")
        taken = real.unionByName(functools.reduce(DataFrame.unionByName, settled)) if settled else real
        taken = taken.distinct().withColumn("taken", F.lit(True))
        checked = stage(
            fresh.join(taken, ["kind", "made"], "left")
            .join(shared, ["kind", "made"], "left")
            .withColumn("bad", F.col("taken").isNotNull() | F.coalesce(F.col("owner") != F.col("normal"), F.lit(False)))
            .select("kind", "normal", "made", "attempt", "bad"),
            "checked-surrogates",
        )
        good, bad = checked.filter("not bad"), checked.filter("bad")
        settled.append(good.select("kind", "made"))
        moved = moved.unionByName(good) if turn else good.limit(0)
        if bad.isEmpty():
            return moved.select("kind", "normal", "attempt") if turn else None
        turn += 1
        if turn >= ATTEMPTS:  # numbers of their own within the group: each round tries surrogates no round has tried
            if turn == ATTEMPTS:
                _check_room(entities)
            rank = F.row_number().over(Window.partitionBy("kind", "made").orderBy("normal"))
            bad = bad.withColumn("attempt", F.col("attempt") + rank)
            fresh = stage(assign(bad, key), "surrogates")
        else:
            fresh = stage(assign(bad, key, turn), "surrogates")


def _check_room(entities: DataFrame) -> None:
    """Numbers of fixed length cannot grow: refuse a corpus that holds half of all there are."""
    for kind, n in entities.filter(F.col("kind").isin(*ROOM)).groupBy("kind").count().collect():
        if 2 * n > ROOM[kind]:
            raise ValueError(f"{n} different entities of kind {kind} leave no room for as many surrogates")


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text", count: str | None = None) -> DataFrame:
    """The documents with surrogates in ``text``; ``count`` names a column for the number of mentions replaced."""
    moved = exceptions(docs, key, text)
    columns = docs.columns
    attempts = free_name(columns, "attempts")
    if moved is None:
        read = docs
    else:
        digest = free_name(columns, "digest")
        marked = docs.withColumn(digest, F.sha2(F.col(text).cast("string"), 256))
        of_text = (
            find_entities(marked, text, (digest,))
            .distinct()
            .join(moved, ["kind", "normal"])
            .groupBy(digest)
            .agg(F.collect_list(F.struct("kind", "normal", "attempt")).alias(attempts))
        )
        read = marked.join(stage(of_text, "exceptions"), digest, "left").drop(digest)
    at, any_moved = columns.index(text), moved is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = functools.lru_cache(maxsize=REMEMBERED)(surrogate)
        for batch in batches:
            texts, numbers = [], []
            for row, value in enumerate(batch.column(at)):
                value = value.as_py()
                held = batch.column(attempts)[row].as_py() if any_moved else None
                by_entity = {(e["kind"], e["normal"]): e["attempt"] for e in held or []}
                new, n = (None, 0) if value is None else replace(value, key, by_entity, known)
                texts.append(new)
                numbers.append(n)
            arrays = [batch.column(k) for k in range(len(columns))]
            arrays[at] = pa.array(texts, pa.string())
            if count:
                arrays.append(pa.array(numbers, pa.int64()))
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = [*columns, *([count] if count else [])]
    schema = docs.schema
    if count:
        schema = docs.select("*", F.lit(0).cast("long").alias(count)).schema
        schema[count].nullable = True
    return read.mapInArrow(run, schema)
