"""Secret scan: fixed patterns plus sliding-window entropy over candidate strings.

A candidate is a maximal run of ``[A-Za-z0-9+/_.=-]`` of at least ``window``
characters.  A window slides over it while counts of its characters are kept
up to date, so each step costs two updates.  Windows whose Shannon entropy
passes the limit of their character class (hexadecimal in either case, or the
groups of letters and digits they hold) are joined into spans of kind ``entropy``, unless the candidate matches
the allow list (addresses, identifiers made of words, file names and the like)
or fixed patterns have found all of it already.  Fixed findings are never suppressed.

Positions are code points; ends are exclusive.  Defined cases: a null or empty
text has no spans; texts of any length are scanned whole; extra columns stay.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from skytrace.llm.common import prepare, with_columns
from skytrace.llm.textbatch import slices

KINDS = ("assign", "access", "hex", "entropy")

#: Fixed patterns; letters of the first may stand in either case (ASCII only).
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Maximal runs of 16 or more: the same as all runs without those that are shorter.
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")

KEYWORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")


@dataclass(frozen=True)
class SecretParams:
    window: int = 20
    #: Bits per character that a window of the class must reach.
    hex_entropy: float = 3.0
    mixed_entropy: float = 3.6
    #: Character groups (lower, upper, digit) a mixed window must hold.
    min_groups: int = 3
    #: Limits of windows with fewer groups: a random one mostly reaches its limit, one made of words hardly.
    lower_digit_entropy: float = 3.6
    upper_digit_entropy: float = 3.5
    letters_entropy: float = 3.8
    one_case_entropy: float = 4.0
    allow: tuple[str, ...] = (
        r"\A[a-z]+([-_./][a-z]+)+\Z",
        r"\A(www\.|https?:)",
        r"\A[\w.-]+\.(com|org|net|html?|php|png|jpe?g|gif|css|js|json|xml|pdf|txt)\b",
        r"(?i)\A(.)\1+\Z",
        r"(?i)example|placeholder|changeme|xxxx",
    )
    #: Names made of words and numbers, which only windows of all groups can mark.
    names: tuple[str, ...] = (
        r"\A[a-z]*([A-Z][a-z]{2,})+\Z",
        r"\A[a-z]{4,}[0-9]{1,4}([a-z]{4,}[0-9]{1,4})*([a-z]{4,})?\Z",
        r"\A([A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4})([-_./]([A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4}))+\Z",
    )


CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]+")


def _group(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def entropy_spans(candidate: str, params: SecretParams) -> list[tuple[int, int]]:
    """Unions of the windows of ``candidate`` that pass their class's limit."""
    w, n = params.window, len(candidate)
    if n < w:
        return []
    counts: Counter[str] = Counter()
    groups = [0, 0, 0, 0]
    strange = 0  # characters in the window that are not lower-case hexadecimal
    strange_upper = 0  # and that are not upper-case hexadecimal
    limits = {} if any(re.search(x, candidate) for x in params.names) else {
        (True, False, True): params.lower_digit_entropy,
        (False, True, True): params.upper_digit_entropy,
        (True, True, False): params.letters_entropy,
        (True, False, False): params.one_case_entropy,
        (False, True, False): params.one_case_entropy,
    }
    plogp = [0.0] + [k * math.log2(k) for k in range(1, w + 1)]
    total = 0.0  # sum of k log k over the window's counts
    spans: list[tuple[int, int]] = []
    for i, c in enumerate(candidate):
        total += plogp[counts[c] + 1] - plogp[counts[c]]
        counts[c] += 1
        groups[_group(c)] += 1
        strange += c not in "0123456789abcdef"
        strange_upper += c not in "0123456789ABCDEF"
        if i >= w:
            gone = candidate[i - w]
            total += plogp[counts[gone] - 1] - plogp[counts[gone]]
            counts[gone] -= 1
            groups[_group(gone)] -= 1
            strange -= gone not in "0123456789abcdef"
            strange_upper -= gone not in "0123456789ABCDEF"
        if i < w - 1:
            continue
        entropy = math.log2(w) - total / w
        if strange == 0:
            hit = entropy >= params.hex_entropy and groups[0] > 0 and groups[2] > 0
        elif strange_upper == 0:
            hit = entropy >= params.hex_entropy and groups[1] > 0 and groups[2] > 0
        else:
            held = groups[0] > 0, groups[1] > 0, groups[2] > 0
            hit = entropy >= (params.mixed_entropy if sum(held) >= params.min_groups else limits.get(held, math.inf))
        if hit:
            start = i - w + 1
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((start, i + 1))
    return spans


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start and then kind."""
    found = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def unions(spans: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """What ``spans``, by start, cover, as stretches that don't touch."""
    out: list[tuple[int, int]] = []
    for s, e, _ in spans:
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def covered(start: int, end: int, stretches: list[tuple[int, int]]) -> bool:
    """Whether one of the stretches, which are in order, holds all from ``start`` to ``end``."""
    at = bisect_right(stretches, (start, math.inf)) - 1
    return at >= 0 and end <= stretches[at][1]


def find_secrets(text: str, params: SecretParams = SecretParams()) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Fixed spans, and all spans including those found by entropy."""
    base = base_spans(text)
    allow = [re.compile(x) for x in params.allow]
    spans = list(base)
    stretches = unions(base)
    for m in CANDIDATE.finditer(text):
        if m.end() - m.start() < params.window or any(a.search(m[0]) for a in allow):
            continue
        for s, e in entropy_spans(m[0], params):
            s, e = s + m.start(), e + m.start()
            if not covered(s, e, stretches):
                spans.append((s, e, "entropy"))
    return base, sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def worth_scanning(raw: bytes) -> bool:
    """False only if no span is possible: every finding but an assignment lies in a word of 16 or more."""
    low = raw.lower()
    return any(k in low for k in KEYWORDS) or any(len(x) >= 16 for x in raw.split())


def render(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for s, e, kind in spans)


COLUMNS = "n_assign long, n_access long, n_hex long, base_spans string, spans string"
NAMES = [x.split()[0] for x in COLUMNS.split(", ")]


def scan(docs: DataFrame, params: SecretParams = SecretParams(), redact: bool = False, placeholder: str = "[SECRET]") -> DataFrame:
    """``docs`` (any columns, with ``text``) plus ``COLUMNS``; ``redact`` also puts ``placeholder`` for every span.

    Input columns that carry one of these names are replaced.
    """
    prepare(docs.sparkSession)
    rest = docs.drop(*NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, off in slices(batches, "text"):
            out: list[list] = [[], [], [], [], []]
            at = batch.schema.get_field_index("text")
            texts = batch.column(at).to_pylist() if redact else None
            for i in range(batch.num_rows):
                raw = data[off[i] : off[i + 1]].tobytes()
                base: list = []
                spans: list = []
                if worth_scanning(raw):
                    text = raw.decode("utf-8", "replace")
                    base, spans = find_secrets(text, params)
                    if redact and spans:
                        texts[i] = redacted(text, spans, placeholder)
                for k, kind in enumerate(KINDS[:3]):
                    out[k].append(sum(s[2] == kind for s in base))
                out[3].append(render(base))
                out[4].append(render(spans))
            columns = list(batch.columns)
            if redact:
                columns[at] = pa.array(texts, pa.large_string())
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(x, pa.int64()) for x in out[:3]), *(pa.array(x, pa.large_string()) for x in out[3:])], names=[*batch.schema.names, *NAMES])

    return with_columns(rest, run, COLUMNS)


def redacted(text: str, spans: list[tuple[int, int, str]], placeholder: str) -> str:
    """``text`` with each union of overlapping spans replaced once."""
    parts, at, end = [], 0, -1
    for s, e, _ in spans:
        if s >= end and end >= 0:
            parts.append(placeholder)
            at, end = end, -1
        if end < 0:
            parts.append(text[at:s])
            end = e
        end = max(end, e)
    if end >= 0:
        parts.append(placeholder)
        at = end
    return "".join([*parts, text[at:]])


def digest(rendered: str) -> str:
    return hashlib.sha256(rendered.encode()).hexdigest()
