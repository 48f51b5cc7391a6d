"""Secret scans: fixed patterns, and windows of high entropy inside candidate strings.

Base spans come from three patterns (``BASE``): an assignment to a name such as ``token`` whose value has 12 or more
characters, an access key of 18 or more, and 16 or more lower-case hex digits. A span is the whole match, in code points.

Method. Candidate strings are the maximal runs of a character class (``CLASSES``) that are at least a window long. A window
of ``width`` characters slides over each; the counts of its characters change by one in and one out, and with them the sum
of c * log2(c), so the Shannon entropy log2(width) - sum / width costs one step a character. The windows at or above the
class's threshold that mix letters and digits are merged to spans. A span goes again if the allow list knows it (``ALLOWED``:
UUIDs, URLs, paths, names made of words, placeholders; words of up to 128 characters) or if a base span or a span of an earlier class holds all of it.
The sums are integers (2^-32 bits), so the same text gives the same spans in every engine and order.

Cases: null text is empty (no span); a text of any length is scanned whole, in time that follows its length; a text that is
one candidate is one run; rows are judged one by one, so ties, repeated rows and null ids need no rule; an empty table gives
an empty result; the other columns stay as they are, whatever their names (the new column takes a free name).
"""
from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterable
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import ship
from shelfwise.llm.tables import append_column, free_name

# Kind, pattern, group that is measured, least characters. Letters of the names count in either case, ASCII only.
BASE = (
    ("assign", r"((?ia:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),  # runs are maximal, so shorter ones need no match
)
WIDTH = 20
# kind, characters, least entropy of a window in bits (20 different characters have 4.32)
CLASSES = (
    ("entropy_hex", "0-9A-Fa-f", 2.9),
    ("entropy_base64", "0-9A-Za-z+/_=-", 3.6),
)
KINDS = (*(b[0] for b in BASE), *(c[0] for c in CLASSES))
# a span, widened to the word it stands in, is no secret if one of these fits it
ALLOWED = (
    r"(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}",  # UUID
    r"(?i)[a-z]+://\S*",  # URL
    r"/?(?:[a-z][a-z0-9_-]{0,15}/)+[a-z0-9._-]*",  # path of short lower-case names
    r"(?:[A-Za-z]+[_-])+[A-Za-z]*\d{0,4}",  # words joined to a name
    r"(?i).*(?:example|placeholder|changeme|your_|xxxx|0123456789|123456789|abcdefgh|qwerty).*",  # placeholders
)
LONGEST_ALLOWED = 128  # longer words are on no allow list
SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
ONE = 1 << 32
_MIXED = re.compile(r"(?=.*[0-9])(?=.*[A-Za-z])", re.S)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns' matches, leftmost and without overlap per kind, in text order."""
    found = []
    for kind, (pattern, group, least) in enumerate(_COMPILED):
        found += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return sorted(found)


def high_windows(run: str, width: int, least: float) -> Iterable[int]:
    """Starts of the windows of ``run`` with an entropy of ``least`` bits or more that hold letters and digits."""
    weigh = [round(c * math.log2(c) * ONE) if c else 0 for c in range(width + 1)]
    most = math.floor((math.log2(width) - least) * width * ONE)  # entropy >= least  <=>  sum of c * log2(c) <= most
    counts: dict[str, int] = {}
    total = digits = letters = 0
    for at, char in enumerate(run):
        c = counts.get(char, 0)
        counts[char] = c + 1
        total += weigh[c + 1] - weigh[c]
        digits += char.isdigit()
        letters += char.isalpha()
        if at >= width:
            gone = run[at - width]
            c = counts[gone]
            counts[gone] = c - 1
            total += weigh[c - 1] - weigh[c]
            digits -= gone.isdigit()
            letters -= gone.isalpha()
        if at >= width - 1 and total <= most and digits and letters:
            yield at - width + 1


def entropy_spans(text: str, held: list[tuple[int, int]], width: int = WIDTH, classes: tuple = CLASSES,
                  allowed: tuple = ALLOWED) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of merged windows of high entropy, without those inside ``held`` or on the allow list."""
    known, out = [re.compile(p) for p in allowed], []
    for kind, (_, chars, least) in enumerate(classes, len(BASE)):
        held = sorted(held)
        reach = list(accumulate((e for _, e in held), max))  # furthest end of the spans that begin up to here
        begins = [s for s, _ in held]
        for m in _runs(chars, width).finditer(text):
            begin, run = m.start(), m[0]
            if not _MIXED.match(run):
                continue
            spans: list[list[int]] = []
            for at in high_windows(run, width, least):
                if spans and begin + at <= spans[-1][1]:
                    spans[-1][1] = begin + at + width
                else:
                    spans.append([begin + at, begin + at + width])
            if not spans:
                continue
            a, b = begin, m.end()
            while a and not text[a - 1].isspace() and b - a <= LONGEST_ALLOWED:  # the word around it, for the allow list
                a -= 1
            while b < len(text) and not text[b].isspace() and b - a <= LONGEST_ALLOWED:
                b += 1
            if b - a <= LONGEST_ALLOWED:
                word = text[a:b].strip("\"'`()[]{}<>,;:.!?")
                if any(p.fullmatch(x) for p in known for x in (word, run)):
                    continue
            out += [(s, kind, e) for s, e in spans if not (i := bisect_right(begins, s)) or reach[i - 1] < e]
        held = held + [(s, e) for s, k, e in out if k == kind]
    return sorted(out)


def _runs(chars: str, width: int) -> re.Pattern:
    return re.compile(f"(?<![{chars}])[{chars}]{{{width},}}")


def scan(text: str) -> list[tuple[str, int, int]]:
    """All spans of a text as (kind, start, end), by start, then kind in the order of ``KINDS``."""
    base = base_spans(text)
    more = entropy_spans(text, [(s, e) for s, _, e in base])
    return [(KINDS[k], s, e) for s, k, e in sorted(base + more)]


def with_secrets(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """All columns of ``docs`` and one with the spans found in ``text``; also the new column's name. No shuffle."""
    def kernel(column: pa.Array) -> pa.Array:
        found = [scan(t.as_py() or "") for t in column]
        return pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in row] for row in found],
                        pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))
    name = free_name(docs, "secrets")
    return append_column(docs, name, SPANS, [text], kernel), name


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kind(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


_COMPILED = [(re.compile(pattern), group, least) for _, pattern, group, least in BASE]

ship(__name__)
