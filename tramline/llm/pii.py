"""Personal data with offset-preserving deobfuscation.

Base identifiers are found in the text as it stands. Then three transducers
rewrite a copy, each keeping for every output character the span of source
characters it stands for: homoglyphs become ASCII, runs of spelled digits
become digits, and at / dot disguises become @ and dots. The same patterns run
on the rewritten text; a match that holds a rewritten character maps back to
source offsets and is added, unless it meets a base span of its kind.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: What precedes and follows the @ of an email. From each @, the leftmost match
#: starts where its run of local characters does, so no long word is rescanned.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: No match starts inside a run of digits, as it would have started with the run.
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

Span = tuple[str, int, int]


def digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def luhn(number: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(number))):
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def ip_ok(m: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.split("."))


def card_ok(m: str) -> bool:
    number = digits(m)
    return 16 <= len(number) <= 19 and luhn(number)


def phone_ok(m: str) -> bool:
    return 8 <= len(digits(m)) <= 15


CHECKS: dict[str, tuple[re.Pattern, Callable[[str], bool]]] = {"ip": (IP, ip_ok), "card": (CARD, card_ok), "phone": (PHONE, phone_ok)}


def emails(text: str) -> list[Span]:
    """Leftmost non-overlapping ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``."""
    out: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append(("email", start, m.end()))
            done = m.end()
        else:
            done = max(done, at + 1)  # no local part goes across an @
        at = text.find("@", at + 1)
    return out


def identifiers(text: str) -> list[Span]:
    """The base identifiers: leftmost non-overlapping matches of each kind that
    pass its check, by kind, then start."""
    out = emails(text)
    digit = DIGIT.search(text) is not None
    for kind in KINDS[1:]:
        if not digit or kind == "phone" and "+" not in text:
            continue
        pattern, check = CHECKS[kind]
        out += [(kind, *m.span()) for m in pattern.finditer(text) if check(m[0])]
    return out


#: Letters of other scripts that look like ASCII ones.
LOOKALIKES = dict(zip(
    "аеорсухіјѕһԁԛԝАВЕКМНОРСТХІЈЅαονρτυχιΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
    "aeopcyxijshdqwABEKMHOPCTXIJSaovptuxiABEZHIKMNOPTYX",
    strict=True,
)) | {"﹫": "@", "․": ".", "。": ".", "‐": "-", "‑": "-", "–": "-", "−": "-"}
INVISIBLE = "­​‌‍⁠﻿"
SUSPECT = re.compile(r"[­Ͱ-ԯ٠-٩۰-۹०-९​-‍‐-–․⁠−①-⑨。﹫﻿！-～\U0001d400-\U0001d7ff]")


def plain(char: str) -> str:
    """The ASCII character that ``char`` stands for; "" if invisible."""
    if char in INVISIBLE:
        return ""
    if char in LOOKALIKES:
        return LOOKALIKES[char]
    flat = unicodedata.normalize("NFKC", char)
    if len(flat) == 1 and flat.isascii():
        return flat
    number = unicodedata.digit(flat, None) if len(flat) == 1 else None
    return char if number is None else str(number)


class Rewritten:
    """A text and where its parts come from, as runs of characters.

    A run is (first character here, start in the source, end in the source,
    changed); its characters stand for one source character each if it is as
    long as its source, else each for the whole of it. A text costs some bytes
    for each run, not for each character.
    """

    def __init__(self, text: str):
        self.text = text
        self.at, self.start, self.end, self.changed = [0], [0], [len(text)], [False]

    def _run(self, pos: int) -> int:
        return bisect_right(self.at, pos) - 1

    def _of(self, k: int, pos: int) -> tuple[int, int]:
        stop = self.at[k + 1] if k + 1 < len(self.at) else len(self.text)
        if stop - self.at[k] != self.end[k] - self.start[k]:
            return self.start[k], self.end[k]
        from_ = self.start[k] + pos - self.at[k]
        return from_, from_ + 1

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The source characters that [start, end) of the text stands for."""
        return self._of(self._run(start), start)[0], self._of(self._run(end - 1), end - 1)[1]

    def touched(self, start: int, end: int) -> bool:
        return any(self.changed[self._run(start) : self._run(end - 1) + 1])

    def apply(self, edits: Iterable[tuple[int, int, str]]) -> None:
        """Replaces [start, end) of the current text, for sorted disjoint edits."""
        text: list[str] = []
        at: list[int] = []
        starts: list[int] = []
        ends: list[int] = []
        changed: list[bool] = []
        size = 0

        def put(n: int, start: int, end: int, new: bool) -> None:
            """``n`` characters for [start, end), joined to the last run if alike."""
            nonlocal size
            single = n == end - start
            if single and at and changed[-1] == new and ends[-1] == start and size - at[-1] == ends[-1] - starts[-1]:
                ends[-1] = end
            else:
                at.append(size)
                starts.append(start)
                ends.append(end)
                changed.append(new)
            size += n

        def copy(begin: int, stop: int) -> None:
            text.append(self.text[begin:stop])
            k = self._run(begin)
            while begin < stop:
                until = min(stop, self.at[k + 1] if k + 1 < len(self.at) else len(self.text))
                put(until - begin, self._of(k, begin)[0], self._of(k, until - 1)[1], self.changed[k])
                begin, k = until, k + 1

        def mark() -> None:
            """The last character counts as changed: one after it is gone."""
            if not at or changed[-1]:
                return
            if size - at[-1] > 1 and size - at[-1] == ends[-1] - starts[-1]:
                ends[-1] -= 1
                at.append(size - 1)
                starts.append(ends[-1])
                ends.append(ends[-1] + 1)
                changed.append(True)
            else:
                changed[-1] = True

        done = 0
        for start, end, new in edits:
            if start > done:
                copy(done, start)
            if new:
                text.append(new)
                put(len(new), *self.source(start, end), True)
            elif end > start:
                mark()
            done = end
        if done < len(self.text):
            copy(done, len(self.text))
        self.text = "".join(text)
        self.at, self.start, self.end, self.changed = (at, starts, ends, changed) if at else ([0], [0], [0], [False])


def homoglyphs(r: Rewritten) -> None:
    r.apply((m.start(), m.end(), new) for m in SUSPECT.finditer(r.text) if (new := plain(m[0])) != m[0])


#: The spelled digits, and the signs said between them.
SPELLED = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}
SAID = {"dot": ".", "point": ".", "plus": "+", "dash": "-", "hyphen": "-"}
NUMBER = "|".join(SPELLED)
TOKEN = re.compile(rf"(?:{NUMBER}|{'|'.join(SAID)})", re.I)
#: A run of spelled digits, at least four, with said signs or written digits between.
SPOKEN = re.compile(rf"\b(?:(?:plus|\+)\s*)?(?:{NUMBER})(?:[\s,-]+(?:{NUMBER}|dot|point|dash|hyphen|[0-9]+)){{3,}}\b", re.I)
#: How such a run begins: wherever it is not found, SPOKEN is not either.
QUICK = re.compile(rf"\b(?:plus\s*)?(?:{NUMBER})[\s,-]+(?:{NUMBER}|dot|point|dash|hyphen|[0-9])", re.I)


def spelled_digits(r: Rewritten) -> None:
    def edits() -> Iterator[tuple[int, int, str]]:
        for run in SPOKEN.finditer(r.text):
            at = run.start()
            for m in re.finditer(r"[A-Za-z]+|[0-9]+|\+", run[0]):
                word = m[0].lower()
                start, end = run.start() + m.start(), run.start() + m.end()
                if start > at:
                    yield at, start, ""
                if word in SPELLED or word in SAID:
                    yield start, end, SPELLED.get(word) or SAID[word]
                at = end

    r.apply(edits())


AT = r"(?:\s*[\[({<]\s*at\s*[\])}>]\s*)"
DOT = r"(?:\s*[\[({<]\s*(?:dot|\.)\s*[\])}>]\s*|\s+dot\s+)"
#: Parts and labels have the lengths and numbers that addresses may have, so a
#: match looks at a bounded stretch of text from wherever it starts.
MOST = "{0,9}"
LOCAL, LABEL = rf"[A-Za-z0-9_%+-]{{1,64}}(?:(?:\.|{DOT})[A-Za-z0-9_%+-]{{1,64}}){MOST}", r"[A-Za-z0-9-]{1,63}"
#: Ends of host names that a bare " at " needs, as prose has "at the dot on".
ENDS = "com|org|net|edu|gov|mil|int|info|biz|io|co|ai|app|dev|eu|de|fr|es|it|uk|ch|nl|be|pl|ru|us|ca|au|jp|cn|in|br"
#: A bracketed "at" may go with plain dots; a bare " at " and an "@" need a disguised dot.
EMAIL = rf"(?<![A-Za-z0-9_%+.-]){LOCAL}(?:{AT}{LABEL}(?:(?:\.|{DOT}){LABEL}){{1,9}}|(?:\s*@\s*){LABEL}(?:\.{LABEL}){MOST}{DOT}{LABEL}(?:(?:\.|{DOT}){LABEL}){MOST}|\s+at\s+(?:{LABEL}(?:\.|{DOT})){MOST}?{LABEL}{DOT}(?:{LABEL}(?:\.|{DOT})){MOST}(?:{ENDS})\b)"
ADDRESS = rf"[0-9]{{1,3}}(?:(?:\.|{DOT})[0-9]{{1,3}}){{3}}"
DISGUISED = re.compile(f"{EMAIL}|{ADDRESS}", re.I)
MARK = re.compile(rf"({AT}|\s+at\s+|\s*@\s*)|({DOT})", re.I)
HINT = re.compile(r"[\[({<]\s*at\s*[\])}>]|\bdot\b|[\[({<]\s*\.\s*[\])}>]", re.I)


def at_and_dot(r: Rewritten) -> None:
    r.apply((m.start() + k.start(), m.start() + k.end(), "@" if k[1] else ".") for m in DISGUISED.finditer(r.text) for k in MARK.finditer(m[0]))


def disguised(text: str, base: list[Span]) -> list[Span]:
    """Spans that only the rewritten text shows, in source offsets.

    ``base``: the identifiers of ``text``, each kind's by start. Linear: what is
    found comes in order, so each span meets one base span and the last found.
    """
    glyphs, spoken = not text.isascii() and SUSPECT.search(text), QUICK.search(text)
    if not (glyphs or spoken or HINT.search(text)):
        return []
    r = Rewritten(text)
    if glyphs:
        homoglyphs(r)
    spelled_digits(r)
    if HINT.search(r.text):
        at_and_dot(r)
    if not any(r.changed):
        return []
    known: dict[str, tuple[list[int], list[int]]] = {kind: ([], []) for kind in KINDS}
    for kind, start, end in base:
        known[kind][0].append(start)
        known[kind][1].append(end)
    out: list[Span] = []
    last = dict.fromkeys(KINDS, 0)
    for kind, start, end in identifiers(r.text):
        if not r.touched(start, end):
            continue
        source = r.source(start, end)
        before = bisect_left(known[kind][0], source[1]) - 1
        if source[0] >= last[kind] and (before < 0 or known[kind][1][before] <= source[0]):
            out.append((kind, *source))
            last[kind] = source[1]
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1])))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: (id_col, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added).

    The counts and ``base_sha256`` are of the base identifiers; ``spans`` holds
    these and the ``n_added`` that deobfuscation adds. Offsets are code points,
    end exclusive. Null and empty texts have none; a null id stays null;
    repeated rows each give a row; an empty table gives none; other columns are
    not read. Texts are searched whole, in time and memory that grow with their
    length. Of two matches at one place the longer email goes first. One narrow pass.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[] for _ in KINDS]
            sha, spans, added = [], [], []
            for text in batch.column(1).to_pylist():
                base = identifiers(text or "")
                more = disguised(text or "", base)
                for column, kind in zip(counts, KINDS, strict=True):
                    column.append(sum(x[0] == kind for x in base))
                sha.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(base + more))
                added.append(len(more))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(sha, pa.string()), pa.array(spans, pa.string()), pa.array(added, pa.int64())],
                [id_col, *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias(text_col))
    return rows.mapInArrow(run, f"`{id_col}` long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
