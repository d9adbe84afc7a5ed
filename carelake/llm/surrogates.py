"""PII: personal data and secrets give way to keyed surrogates of the same kind and format.

Entities are found by their form: mail addresses, phone, account and card
numbers, IP addresses, secrets behind a telling word, and persons (a title or a
listed given name beside a capitalised word).  Names of persons found in a
document are entities wherever it has them again, alone and in any case.  An
entity's key leaves out what its writing may vary (case, blanks between digits),
so all its mentions in all documents get one surrogate, each in the mention's own
writing.

A surrogate is drawn by a keyed hash of kind, key and attempt: letters for
letters of the same script, digits for digits, signs kept, check digits valid
where they were.  Given names go to another name of the same script and gender
by a keyed rotation of their list; surnames keep their gendered ending.

Distinct entities stay distinct.  All distinct entities of the corpus are drawn
once in a table; those that fall on another's surrogate, or on any real entity,
are drawn again until none does.  After ``WIDEN`` attempts a surrogate grows by
a letter or digit, so this ends in crowded formats too.  Only entities that
needed another attempt travel back to the documents that mention them; every
other surrogate follows from the key alone.

Defined results: a null text is empty and stays so.  Repeated rows and null ids
are returned as given.  Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hmac
import re
from bisect import bisect_left
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import shared

KEY = b"carelake surrogates"
WIDEN = 8

GIVEN = {
    ("latin", "f"): "Alice Amelia Anna Catherine Charlotte Claire Elena Elisabeth Emma Ingrid Isabel Julia Laura Lucia "
    "Maria Martina Olivia Rebecca Sophie Susan Teresa Victoria".split(),
    ("latin", "m"): "Albert Antonio Benjamin Carlos Charles Daniel Dietrich Edward Francis Frederik George Henri James "
    "John Laurent Martin Michael Oliver Peter Robert Thomas William".split(),
    ("cyrillic", "f"): "Анастасия Вера Дарья Екатерина Елена Ирина Мария Наталья Ольга Светлана Татьяна Юлия".split(),
    ("cyrillic", "m"): "Александр Алексей Борис Виктор Владимир Дмитрий Иван Михаил Николай Павел Сергей Юрий".split(),
    ("greek", "f"): "Αικατερίνη Άννα Βασιλική Γεωργία Ελένη Ευαγγελία Ιωάννα Μαρία Σοφία".split(),
    ("greek", "m"): "Αντώνης Βασίλης Γεώργιος Δημήτρης Ιωάννης Κώστας Μιχάλης Νικόλαος Παναγιώτης".split(),
}
TITLES = "Mr Mrs Ms Miss Dr Prof Herr Frau Monsieur Madame Señor Señora Sir Lady".split()
#: Titles that are other words when written in capitals.
NO_CAPITALS = {"Miss", "Ms"}
#: Words that stand beside names and are none: not looked for again, and no surname of a text in capitals.
COMMON = frozenset(
    "a an and are as at but by for from had has have he her his i if in is it its my no not of on or our she so that the "
    "their then there they this to was we were who will with you your "
    "aber als am auf aus bei das dem den der des die du ein eine er es hat ich im ist mit nicht oder sie sind und von war "
    "wir zu zum zur "
    "au aux avec ce ces dans elle en est et il la le les mais nous par pas pour que qui sa se ses son sur un une "
    "al con como de del e ella el ellos era las lo los mi muy o para pero por se si sin su sus una y ya da do dos "
    "без был была был в во для до его ее же за и из или к как мы на не но о он она они от по при с со то ты у что это я "
    "αν από για δεν ένα η ή θα και με να ο οι που σε στη στην στο τα την της τι το του των".split()
)
ENDINGS = ("ова", "ева", "ина", "ская", "ов", "ев", "ин", "ский", "όπουλος", "οπούλου", "ίδης", "άκης")
LETTERS = {
    "latin": ("bcdfghklmnprstvz", "aeiou"),
    "cyrillic": ("бвгдзклмнпрст", "аеиоу"),
    "greek": ("βγδζκλμνπρστ", "αειου"),
}

FORMS = re.compile(
    r"""
    (?P<mail>(?<![\w.+%-])[\w.+%-]{1,64}@[\w-]+(?:\.[\w-]+)+)
  | \b(?:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key|key)\b["']?\s*[:=]\s*["']?(?P<secret>[A-Za-z0-9_/+-]{8,})
  | (?P<iban>\b[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){3,7}(?:[ ]?[A-Z0-9]{1,3})?\b)
  | (?P<ip6>(?<![\w:])(?:[0-9a-f]{1,4}:){7}[0-9a-f]{1,4}(?![\w:]))
  | (?P<ip>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d))
  | (?P<card>(?<![\d+])\d(?:[ -]?\d){12,18}(?!\d))
  | (?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))
  | (?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{2,4})[ .-]\d{3,4}[ .-]?\d{3,4}(?!\d))
  | (?P<phone2>(?<![\w+])\+\d{1,3}[ .-]?\d{2,4}(?:[ .-]?\d{2,4}){2,4}(?!\d))
    """,
    re.VERBOSE | re.IGNORECASE,
)
HINTS = ("@", "token", "secret", "passw", "key", *"0123456789")
#: Digits of a card written in groups.
CARD_GROUPS = {(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3)}
_DIGIT, _NUMBER = re.compile(r"\d"), re.compile(r"\d+")
_SURNAME = re.compile(r"\.? +([^\W\d_]+(?:-[^\W\d_]+)?)")
_RUN, _PART = re.compile(r"[^\W_]+(?:-[^\W_]+)*"), re.compile(r"[^\W_]+")
Mention = tuple[int, int, str, str]


def _names() -> tuple[ahocorasick.Automaton, dict[str, tuple[str, str]]]:
    found = ahocorasick.Automaton()
    of = {name: group for group, names in GIVEN.items() for name in names}
    for name in [*of, *TITLES]:
        if name not in NO_CAPITALS:
            found.add_word(name.upper(), name.upper())
        found.add_word(name, name)
    found.make_automaton()
    return found, of


_AUTOMATON, _GROUP = _names()
_LISTED = {name.casefold(): name for name in _GROUP}


def mentions(text: str) -> list[Mention]:
    """``(start, end, kind, key)`` of each entity, in order and without overlap."""
    out: list[Mention] = []
    m = FORMS.search(text) if _may_hold(text) else None
    while m:
        kind = m.lastgroup.rstrip("2")
        start, end = m.span(m.lastgroup) if kind != "card" else _card(text, *m.span())
        out.append((start, end, kind, _key(kind, text[start:end])))
        m = FORMS.search(text, end if kind == "card" else m.end())
    persons: list[Mention] = []
    unsure = set()
    for last, name in _AUTOMATON.iter(text):
        start, end = last - len(name) + 1, last + 1
        if (start and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum()):
            continue
        m = _SURNAME.match(text, end)
        if not m or not m.group(1)[0].isupper():
            continue
        given, surname = name.casefold() in _LISTED, _name(m.group(1))
        if name.isupper() and (not m.group(1).isupper() or surname[1] in COMMON):
            continue
        if given:
            persons.append((start, end, *_name(name)))
        persons.append((m.start(1), m.end(1), *surname))
        if given and text[end] == ".":  # perhaps a new sentence
            unsure.add(persons[-1])
    merged, free = [], 0
    for m in sorted(set(out + persons)):
        if m[0] >= free:
            merged.append(m)
            free = m[1]
    return _with_further(text, merged, unsure)


def _name(word: str) -> tuple[str, str]:
    """Kind and key of a name: listed names are given names wherever they stand."""
    key = word.casefold()
    return ("given", _LISTED[key]) if key in _LISTED else ("surname", key)


def _with_further(text: str, found: list[Mention], unsure: set[Mention]) -> list[Mention]:
    """``found``, and between its mentions the words of any case that are names among them."""
    names = {m[3].casefold() for m in found if m[2] in ("given", "surname") and m not in unsure} - COMMON
    if not names:
        return found
    starts, out = [m[0] for m in found], list(found)
    for run in _RUN.finditer(text):
        whole = run.group().casefold() in names
        for m in (run,) if whole or "-" not in run.group() else _PART.finditer(text, *run.span()):
            if m.group().casefold() in names:
                before = bisect_left(starts, m.end())
                if not before or found[before - 1][1] <= m.start():
                    out.append((*m.span(), *_name(m.group())))
    return sorted(out)


def _card(text: str, start: int, end: int) -> tuple[int, int]:
    """Where the card lies among numbers that blanks or hyphens join.

    Best in one run or a card's groups with a valid check digit, then in these
    without, then up to the last valid check digit, else all.
    """
    groups = [m.span() for m in _NUMBER.finditer(text, start, end)]
    best, where = (0, 0, 0), (start, end)
    for i, (low, _) in enumerate(groups):
        sizes: tuple[int, ...] = ()
        for first, high in groups[i:]:
            sizes += (high - first,)
            if 13 <= (n := sum(sizes)) <= 19:
                shaped = sizes in CARD_GROUPS or len(sizes) == 1
                valid = _luhn(_key("card", text[low:high])) == 0
                if shaped and (valid or len(sizes) < 5):
                    rank = (2 + valid, 0, -i)
                elif valid and i == 0:
                    rank = (1, n, 0)
                else:
                    continue
                if rank > best:
                    best, where = rank, (low, high)
    return where


def _may_hold(text: str) -> bool:
    """Whether the text has what every form needs; substrings are found far faster than patterns."""
    low = text.lower()
    return (
        any(hint in low for hint in HINTS) or low.count(":") >= 7
        or (not text.isascii() and _DIGIT.search(text) is not None)
    )


def _key(kind: str, text: str) -> str:
    if kind in ("phone", "card", "ssn"):
        return re.sub(r"\D", "", text)
    if kind == "iban":
        return text.replace(" ", "").lower()
    return text.lower() if kind != "secret" or text.isupper() else text


class Draw:
    """Numbers from a keyed hash."""

    def __init__(self, key: bytes, *of: object) -> None:
        self.message = "\x1f".join(map(str, of)).encode("utf-8", "surrogatepass")
        self.key, self.pool, self.round = key, 0, 0

    def below(self, n: int) -> int:
        if self.pool < 1 << 64:
            self.round += 1
            digest = hmac.digest(self.key, self.message + bytes(f"\x1f{self.round}", "ascii"), "sha256")
            self.pool = int.from_bytes(digest, "big") | 1 << 256
        self.pool, value = divmod(self.pool, n)
        return value


def script(text: str) -> str:
    for c in text:
        if "Ͱ" <= c <= "Ͽ" or "ἀ" <= c <= "῿":
            return "greek"
        if "Ѐ" <= c <= "ӿ":
            return "cyrillic"
    return "latin"


def _same_form(text: str, draw: Draw, hexadecimal: bool = False) -> str:
    """Letters for letters, digits for digits, signs as they are."""
    out = []
    for i, c in enumerate(text):
        if c.isdigit():
            out.append(str(draw.below(10)))
        elif c.isalpha():
            hard, soft = LETTERS[script(c)]
            some = "abcdef" if hexadecimal else (soft if i % 2 else hard)
            new = some[draw.below(len(some))]
            out.append(new.upper() if c.isupper() else new)
        else:
            out.append(c)
    return "".join(out)


def _luhn(digits: str) -> int:
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10


def surrogate(kind: str, key: str, attempt: int = 0, secret: bytes = KEY) -> str:
    """The key of the entity that stands in for ``key``."""
    draw = Draw(secret, kind, key, attempt)
    wide = "".join(str(draw.below(10)) for _ in range(max(0, attempt - WIDEN)))
    if kind == "given":
        names = GIVEN[_GROUP[key]]
        shift = 1 + Draw(secret, "given", *_GROUP[key]).below(len(names) - 1)
        return names[(names.index(key) + shift) % len(names)]
    if kind == "mail":
        local, _, domain = key.partition("@")
        host, _, top = domain.rpartition(".")
        return f"{_same_form(local, draw)}{wide}@{_same_form(host, Draw(secret, 'host', domain))}.{top}"
    if kind == "ip":
        return ".".join(_octet(len(part) if attempt <= WIDEN else 3, draw) for part in key.split("."))
    if kind in ("phone", "ssn", "card"):
        keep = 1 if kind == "phone" else 0
        new = key[:keep] + "".join(str(draw.below(10)) for _ in key[keep:]) + wide
        if kind == "card" and _luhn(key) == 0:
            new = next(n for n in (new[:-1] + str(d) for d in range(10)) if _luhn(n) == 0)
        return new
    if kind == "iban":
        return key[:2] + _same_form(key[2:], draw) + wide
    if kind == "surname":
        end = next((e for e in ENDINGS if key.endswith(e) and len(key) > len(e) + 1), "")
        extra = max(0, attempt - WIDEN) + max(0, 4 - len(key))
        stem = key[: len(key) - len(end)]
        return _same_form(stem + stem[:1] * extra, draw) + end
    return _same_form(key, draw, bool(re.fullmatch("[0-9a-fA-F:]+", key))) + wide


def _octet(digits: int, draw: Draw) -> str:
    low, high = ((1, 10), (10, 100), (100, 255))[digits - 1]
    return str(low + draw.below(high - low))


def _written(kind: str, mention: str, new: str) -> str:
    """``new`` in the writing of the mention: its signs, blanks and case."""
    if kind in ("phone", "card", "ssn", "iban"):
        chars = iter(new)
        out = [next(chars, "") if c.isalnum() else c for c in mention] + list(chars)
        new = "".join(out)
    if mention.isupper():
        return new.upper()
    if kind == "given" and mention.islower():
        return new.lower()
    if kind == "surname" and mention[:1].isupper():
        return "-".join(p[:1].upper() + p[1:] for p in new.split("-"))
    if len(mention) == len(new) and kind in ("mail", "secret", "ip6", "iban"):
        return "".join(n.upper() if m.isupper() else n for m, n in zip(mention, new))
    return new


def replaced(text: str, attempts: dict[tuple[str, str], int], secret: bytes = KEY) -> tuple[str, int]:
    """The text with surrogates, and how many mentions it had."""
    found = mentions(text)
    out, at = [], 0
    for start, end, kind, key in found:
        new = surrogate(kind, key, attempts.get((kind, key), 0), secret)
        out += [text[at:start], _written(kind, text[start:end], new)]
        at = end
    return "".join([*out, text[at:]]), len(found)


def entities(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, kind, key``: what each document mentions, once."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, kinds, keys = [], [], []
            for i, text in enumerate(batch.column("text")):
                for k, key in {(m[2], m[3]) for m in mentions(text.as_py() or "")}:
                    at.append(i)
                    kinds.append(k)
                    keys.append(key)
            where = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(where), batch.column("text_key").take(where),
                 pa.array(kinds, pa.string()), pa.array(keys, pa.string())],
                ["doc_id", "text_key", "kind", "key"],
            )

    return _keyed(docs).mapInArrow(of, f"doc_id {kind}, text_key bigint, kind string, key string")


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("text_key"))


def _drawn(rows: DataFrame, attempt: int, secret: bytes) -> DataFrame:
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("kind").to_pylist(), batch.column("key").to_pylist())
            new = [surrogate(kind, key, attempt, secret) for kind, key in pairs]
            yield pa.RecordBatch.from_arrays(
                [batch.column("kind"), batch.column("key"), pa.array(new, pa.string())], ["kind", "key", "new"]
            )

    drawn = rows.select("kind", "key").mapInArrow(of, "kind string, key string, new string")
    return drawn.withColumn("attempt", F.lit(attempt))


def registry(found: DataFrame, secret: bytes = KEY) -> DataFrame:
    """``kind, key, new, attempt`` for each distinct entity; ``new`` is no other's and no real one.

    Given names need no check: their lists are rotated, so they stay distinct.
    """
    real = shared.written(found.select("kind", "key").distinct(), "pii-entities")
    settled, waiting, attempt = None, real.where("kind <> 'given'"), 0
    while True:
        drawn = shared.written(_drawn(waiting, attempt, secret), "pii-drawn")
        taken = real.select("kind", F.col("key").alias("new"))
        if settled is not None:
            taken = taken.union(settled.select("kind", "new"))
        first = drawn.groupBy("kind", "new").agg(F.min("key").alias("key"))
        fine = first.join(taken, ["kind", "new"], "left_anti").select("kind", "key", "new")
        fine = fine.withColumn("attempt", F.lit(attempt))
        settled = shared.written(fine if settled is None else settled.union(fine), "pii-settled")
        waiting = shared.written(
            drawn.select("kind", "key").join(settled.select("kind", "key"), ["kind", "key"], "left_anti"), "pii-waiting"
        )
        if waiting.isEmpty():
            return settled
        attempt += 1


def pseudonymised(docs: DataFrame, secret: bytes = KEY) -> DataFrame:
    """``doc_id, text, n_replaced``: whole texts with surrogates."""
    found = shared.written(entities(docs), "pii-mentions")
    again = registry(found, secret).where("attempt > 0").select("kind", "key", "attempt")
    retold = (
        found.join(again, ["kind", "key"])
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set(F.struct("kind", "key", "attempt")).alias("again"))
        .withColumnsRenamed({"doc_id": "_id", "text_key": "_key"})
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    rows = _keyed(docs).join(retold, same, "left").select("doc_id", "text", "again")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            for text, again in zip(batch.column("text"), batch.column("again")):
                attempts = {(a["kind"], a["key"]): a["attempt"] for a in again.as_py() or ()}
                new, n = replaced(text.as_py() or "", attempts, secret)
                texts.append(new)
                counts.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(counts, pa.int64())],
                ["doc_id", "text", "n_replaced"],
            )

    return rows.mapInArrow(of, f"doc_id {kind}, text string, n_replaced bigint")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymised(shared.table(spark, sf_dir, "documents"))
