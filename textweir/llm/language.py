"""Language identification with string kernels.

The kernel of two texts counts the character n-grams of one to `N` characters
that both contain (a blended spectrum of presence features), normalised to
one for equal sets. A bounded sample of labelled rows is mapped onto Nyström
landmarks, and one-versus-rest kernel ridge regression is fitted in that
space. A kernel against landmarks is linear in a text's presence vector, so
landmarks and regression weights fold into one matrix, and a batch of texts
is scored by one matrix product.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textweir.llm.common import NULL_ID

#: Longest n-gram.
N = 3
#: Bounds of the labelled sample: rows of each language, and characters of a row.
SAMPLE, SAMPLE_CHARS = 300, 1 << 20
#: Landmarks of each language.
LANDMARKS = 48
RIDGE = 1e-3
BATCH = 64
_BITS = np.uint64(21)


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def presence(text: str) -> np.ndarray:
    """Ids of the distinct n-grams of a text, blanks around it included; what is no letter counts as a blank.

    An id is made of the n-gram's code points themselves, so all alphabets are told apart.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    code = np.zeros(len(points) + 4, np.uint64)
    code[2:-2] = np.where(letters()[points], points, 0)
    third = _distinct((((code[:-2] << _BITS) | code[1:-1]) << _BITS) | code[2:])
    second = _distinct(third >> _BITS)
    first = _distinct(second >> _BITS)
    return np.concatenate([first | np.uint64(3 << 62), second | np.uint64(1 << 63), third])


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])]


@dataclass
class Model:
    langs: list[str]
    vocabulary: np.ndarray  # n-grams of the landmarks, sorted
    weights: np.ndarray  # n-grams of the landmarks x languages

    def scores(self, texts: list[str]) -> np.ndarray:
        """Decision values, texts x languages."""
        if not texts:
            return np.zeros((0, len(self.langs)), np.float32)
        found = [presence(text) for text in texts]
        return (_matrix(found, self.vocabulary) @ self.weights) / np.sqrt([[len(ids)] for ids in found]).astype(np.float32)


def _matrix(found: list[np.ndarray], vocabulary: np.ndarray) -> np.ndarray:
    """Which n-grams of the vocabulary each text has."""
    matrix = np.zeros((len(found), len(vocabulary)), np.float32)
    for row, ids in zip(matrix, found, strict=True):
        at = np.minimum(np.searchsorted(vocabulary, ids), len(vocabulary) - 1)
        row[at[vocabulary[at] == ids]] = 1
    return matrix


def fit(rows: list[tuple[str, str]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """A model of (lang, text) rows; None without any."""
    rows = [(lang, text) for lang, text in rows if has_letter(text)]
    if not rows:
        return None
    langs = sorted({lang for lang, _ in rows})
    found = [presence(text) for _, text in rows]
    chosen, seen = [], Counter()
    for i, (lang, _) in enumerate(rows):
        if seen[lang] < landmarks:
            seen[lang] += 1
            chosen.append(i)
    vocabulary = np.unique(np.concatenate([found[i] for i in chosen]))
    points = _matrix(found, vocabulary) / np.sqrt([[len(ids)] for ids in found]).astype(np.float32)
    basis = points[chosen]
    values, vectors = np.linalg.eigh((basis @ basis.T).astype(np.float64))
    held = values > 1e-6 * values.max()
    root = vectors[:, held] / np.sqrt(values[held])  # K_zz^(-1/2) on its range
    phi = (points @ basis.T).astype(np.float64) @ root
    target = np.array([[float(lang == x) for x in langs] for lang, _ in rows])
    weight = np.array([1 / np.sqrt(sum(r[0] == lang for r in rows)) for lang in langs])[[langs.index(lang) for lang, _ in rows]][:, None]
    weight *= np.sqrt(len(rows) / len(langs))  # languages count alike
    inside = (phi * weight).T @ (phi * weight) + ridge * len(rows) * np.eye(phi.shape[1])
    solved = np.linalg.solve(inside, (phi * weight).T @ (target * weight))
    return Model(langs, vocabulary, (basis.T @ (root @ solved)).astype(np.float32))


def held_out(column: str = "doc_id"):
    """Rows kept from training: crc32 of the id as text is 2 modulo 4. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, sample: int = SAMPLE, chars: int = SAMPLE_CHARS) -> Model | None:
    """Fit on at most `sample` rows of each language, chosen by a hash of id and text among those not held out; rows of more than `chars` characters are not chosen."""
    rows = docs.select("doc_id", "lang", "text").where(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & (F.length("text") <= chars))
    counts = {r["lang"]: r["count"] for r in rows.select("lang").groupBy("lang").count().collect()}
    if not counts:
        return None
    order = F.xxhash64("doc_id", "text").bitwiseAND(F.lit(NULL_ID))
    bound = F.lit(0)
    for lang, n in counts.items():  # about twice as many as are needed
        bound = F.when(F.col("lang") == lang, F.lit(min(NULL_ID, int(NULL_ID * (2 * sample + 20) / n)))).otherwise(bound)
    near = rows.select("lang", "text", order.alias("at")).where(F.col("at") <= bound)
    first = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("at", "text"))).where(F.col("rank") <= sample)
    return fit([(r["lang"], r["text"]) for r in sorted(first.collect(), key=lambda r: (r["lang"], r["rank"]))])


def _best(model: Model | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and score of each text."""
    lang, score = ["und"] * len(texts), [0.0] * len(texts)
    known = [i for i, text in enumerate(texts) if model and has_letter(text)]
    for at in range(0, len(known), BATCH):
        part = known[at : at + BATCH]
        values = model.scores([texts[i] for i in part])
        for i, row, k in zip(part, values, values.argmax(axis=1), strict=True):
            lang[i], score[i] = model.langs[k], float(min(1.0, max(0.0, row[k])))
    return lang, score


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row.

    Texts that are null or have no letter are `und` with score 0, and so is
    every text if nothing was learned. A null id is not held out; repeated
    rows are each scored; of equal scores the first language in order of the
    names wins; an empty table gives no rows. Columns other than doc_id and
    text are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            lang, score = _best(shared.value, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    given = docs.select("doc_id", held_out().alias("held_out"), "text")
    return given.mapInArrow(batches, f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, lang_pred string, score double")


def in_known_language(docs: DataFrame, model: Model | None, least: float) -> DataFrame:
    """The rows of `docs`, with all their columns, whose language scores `least` or more; texts that are `und` go."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            lang, score = _best(shared.value, batch.column("text").to_pylist())
            yield batch.filter(pa.array([x != "und" and s >= least for x, s in zip(lang, score, strict=True)], pa.bool_()))

    return docs.mapInArrow(batches, docs.schema)
