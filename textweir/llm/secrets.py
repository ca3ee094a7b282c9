"""Secret scanning: fixed patterns and a token-efficiency test.

A tokenizer trained on ordinary text needs many tokens for a random string.
Runs of identifier characters whose characters-per-token ratio is low are
reported, after known digests (hex of a digest's length, UUIDs) and ordinary
identifiers are set aside. The patterns' own spans always stay.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame

#: A public byte-level BPE vocabulary in tiktoken's rank format.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Characters per token below which a run is random.
RATIO = 2.2
#: Shortest run that is tested.
SHORTEST = 20

# The patterns of the base spans and the digest lengths.
ASSIGN = re.compile(r"""(?ai)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
KEYWORDS = ("token", "secret", "passw", "apikey", "api_key")
DIGEST_LENGTHS = frozenset((32, 40, 48, 56, 64, 96, 128))
PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

RUN = re.compile(rf"[A-Za-z0-9+/_=-]{{{SHORTEST},}}")
ALL_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")
UUID = re.compile(r"(?i)[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}")
#: The parts of an identifier: words in camel case, capitals, numbers.
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
#: Characters that are tokenized at once, as a run has no bound and the tokenizer's time grows faster than its input.
PIECE = 1024
#: Largest vocabulary file that is sent to the executors.
MOST_VOCABULARY = 64 << 20


@lru_cache(maxsize=4)
def encoding(ranks: bytes):
    """A tokenizer of the lines of a vocabulary file."""
    import tiktoken

    pairs = (line.split() for line in ranks.splitlines())
    return tiktoken.Encoding("vocabulary", pat_str=PIECES, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})


@lru_cache(maxsize=4)
def vocabulary_bytes(path: str) -> bytes:
    data = Path(path).read_bytes()
    if len(data) > MOST_VOCABULARY:
        raise ValueError(f"{path} has more than {MOST_VOCABULARY} bytes")
    return data


def is_identifier(run: str) -> bool:
    """Whether a run is made of words of three letters or more, shorter ones before a separator, and numbers of up to four digits."""
    for part in PART.finditer(run):
        size, end = part.end() - part.start(), part.end()
        if part[0].isdigit():
            if size > 4:
                return False
        elif size < 3 and run[end : end + 1] not in ("_", "/", "-"):
            return False
    return True


def is_random(run: str, ranks: bytes, ratio: float = RATIO) -> bool:
    """Whether a run of identifier characters looks like a random string."""
    kinds = any(map(str.islower, run)) + any(map(str.isupper, run)) + any(map(str.isdigit, run))
    if kinds < 2 or UUID.fullmatch(run) or is_identifier(run):
        return False
    if len(run) in DIGEST_LENGTHS and ALL_HEX.fullmatch(run):
        return False
    encode = encoding(ranks).encode_ordinary
    return len(run) < ratio * sum(len(encode(run[at : at + PIECE])) for at in range(0, len(run), PIECE))


def find(text: str | None, ranks: bytes, ratio: float = RATIO) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """Base spans as (start, kind, end), with kinds 0 assign, 1 access, 2 hex; and the added spans (start, end)."""
    if not text:
        return [], []
    lower = text.lower()
    base = []
    if any(word in lower for word in KEYWORDS):
        base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    if "AKIA" in text:
        base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    base += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base.sort()
    added, at, taken = [], 0, 0  # base spans before `at` begin before the run's end; `taken` is where they end
    for m in RUN.finditer(text):
        while at < len(base) and base[at][0] < m.end():
            taken = max(taken, base[at][2])
            at += 1
        if taken <= m.start() and is_random(m[0], ranks, ratio):
            added.append(m.span())
    return base, added


KINDS = ("assign", "access", "hex")


def scan(docs: DataFrame, vocabulary: str = VOCABULARY, ratio: float = RATIO) -> DataFrame:
    """Secrets of every row of `docs`: counts and digest of the base spans, and all spans as kind:start:end.

    Offsets are code points, ends exclusive; added spans have kind `random`.
    Null and empty texts give zeros and empty strings; a null id stays null;
    repeated rows are each scanned; base spans of different kinds may overlap
    and all stay; very long texts take time in proportion to their length; an
    empty table gives no rows; columns other than doc_id and text are not
    read. The vocabulary file is read by the driver and sent along.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary_bytes(vocabulary))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            rows = []
            for value in batch.column("text"):
                base, added = find(value.as_py(), shared.value, ratio)
                told = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in base)
                spans = told
                if added:
                    spans = ",".join(f"{name}:{a}:{b}" for a, _, name, b in sorted([(a, k, KINDS[k], b) for a, k, b in base] + [(a, 3, "random", b) for a, b in added]))
                kinds = [k for _, k, _ in base]
                rows.append((kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(told.encode()).hexdigest(), spans))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(batches, f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")
