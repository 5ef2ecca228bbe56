"""Language identification by error-correcting output codes.

Every language has a codeword. One binary classifier per bit, a ridge
regression on hashed character bigrams and trigrams, predicts a margin; the
codeword with the least logistic loss against the margins wins. A text is
ambiguous when the bits lie further from the winner than the code can correct,
or when two codewords are about as good.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.llm.common import byte_slices, checkpointed, mixed

UNKNOWN = "und"
_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether each code point is a letter, once per Python process."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1))
    return _LETTERS[0]


def features(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """One row per text of hashed bigrams and trigrams, and whether the text has a letter.

    Case is folded; all that isn't a letter counts as one space, so n-grams
    know where words begin and end. Rows are square roots of counts, scaled to
    length one.
    """
    lower = [t.lower() for t in texts]
    codes = np.frombuffer("  ".join(["", *lower, ""]).encode("utf-32-le", "replace"), dtype="<u4")
    codes = codes.astype(np.uint64)
    is_letter = letters()[codes]
    codes = np.where(is_letter, codes, np.uint64(32))
    sizes = np.array([len(t) + 2 for t in lower])
    row = np.repeat(np.arange(len(texts)), sizes)
    # The two spaces before a text belong to it; those of the next one end its last grams.
    counts = np.zeros(len(texts) * width, dtype=np.int64)
    for n in (2, 3):
        grams = np.zeros(len(codes) - n + 1, dtype=np.uint64)
        some = np.zeros(len(grams), dtype=bool)
        for k in range(n):
            grams = (grams << np.uint64(21)) | codes[k : k + len(grams)]
            some |= is_letter[k : k + len(grams)]
        bucket = (mixed(grams + np.uint64(n)) % np.uint64(width)).astype(np.int64)
        own = row[: len(grams)]
        some = some[: len(own)]
        counts += np.bincount((own * width + bucket[: len(own)])[some], minlength=len(counts))
    rows = np.sqrt(counts.reshape(len(texts), width).astype(np.float32))
    norms = np.sqrt((rows**2).sum(axis=1))
    firsts = np.cumsum(sizes) - sizes
    has_letter = np.add.reduceat(is_letter[: sizes.sum()], firsts) > 0 if len(texts) else np.zeros(0, bool)
    return rows / np.maximum(norms, 1e-9)[:, None], has_letter


def codewords(classes: int, seed: int = 42) -> np.ndarray:
    """A codeword of -1 and 1 per class, the nearest two of them far apart.

    Up to 6 classes get all distinct ways to split them in two; more get the
    best of many random codes of 8 bits per doubling of the classes.
    """
    if classes < 2:
        return np.ones((classes, 1))
    if classes <= 6:
        splits = [[1 if s >> c & 1 else -1 for c in range(classes)] for s in range(1, 1 << (classes - 1))]
        return np.array(splits, dtype=np.float64).T
    random = np.random.default_rng(seed)
    bits = int(8 * np.ceil(np.log2(classes)))
    best, apart = None, -1
    for _ in range(200):
        code = random.choice([-1.0, 1.0], size=(classes, bits))
        distance = (bits - code @ code.T) / 2
        least = distance[~np.eye(classes, dtype=bool)].min()
        if least > apart and (np.abs(code.sum(axis=0)) < classes).all():
            best, apart = code, least
    return best


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    width: int

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, ambiguous) of each text; `und`, 0 and True where it is null or has no letter."""
        texts = [t or "" for t in texts]
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
        rows, has_letter = features(texts, self.width)
        margins = rows @ self.weights + self.bias
        losses = np.logaddexp(0, -4 * margins[:, None, :] * self.codes[None]).sum(axis=2)
        order = np.argsort(losses, axis=1, kind="stable")
        best = order[:, 0]
        shares = np.exp(losses.min(axis=1, keepdims=True) - losses)
        score = 1 / shares.sum(axis=1)
        distance = self._distances()
        wrong = (np.sign(margins) != self.codes[best]).sum(axis=1)
        ambiguous = ~has_letter | (score < 0.5) | (2 * wrong >= distance)
        names = [self.languages[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), has_letter.tolist(), strict=True)]
        return names, np.where(has_letter, score, 0.0), ambiguous

    def _distances(self) -> float:
        """Bits in which the two nearest codewords differ; one language alone is never ambiguous by them."""
        if len(self.languages) < 2:
            return 2.0 * self.codes.shape[1] + 1
        distance = (self.codes.shape[1] - self.codes @ self.codes.T) / 2
        return distance[~np.eye(len(self.languages), dtype=bool)].min()


def fit(
    docs: DataFrame,
    text_col: str = "text",
    label_col: str = "lang",
    most: int = 2000,
    width: int = 4096,
    ridge: float = 0.3,
) -> Model:
    """A model of the labels of `docs`, fitted on at most about `most` different texts.

    Each label gives its share of the texts, those with the least hashes;
    copies count once. A label's hashes are counted first, and only the low share
    of them that holds the sample is ranked, so no task gets a label's rows.
    Null labels and null texts aren't used. Features are
    made by the executors from whole texts; the driver gets one row of `width`
    numbers for each text of the sample.
    """
    known = docs.select(docs[text_col].alias("text"), docs[label_col].alias("label")).filter(
        "text is not null and label is not null"
    )
    hashed = known.select("label", F.xxhash64("text").alias("h"), "text")
    pairs = checkpointed(hashed.select("label", "h").distinct())
    sizes = pairs.groupBy("label").count()
    labels = sizes.count()
    if not labels:
        return Model([], np.zeros((0, 1)), np.zeros((width, 1)), np.zeros(1), width)
    each = max(1, most // labels)
    # Hashes lie evenly in -2^63 to 2^63, so about 2 * each + 100 of a label are in the share that is ranked.
    near = F.col("h") / F.lit(2.0**64) + 0.5 < (2 * each + 100) / F.col("count")
    ranked = Window.partitionBy("label").orderBy("h")
    chosen = (
        pairs.join(F.broadcast(sizes) if labels <= most else sizes, "label")
        .filter(near)
        .withColumn("n", F.row_number().over(ranked))
        .filter(F.col("n") <= each)
    )
    # At most `most` rows, or one per label, of two columns.
    picked = hashed.join(F.broadcast(chosen.select("label", "h")), ["label", "h"]).dropDuplicates(["label", "h"])

    def made(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(1).to_pylist()
            for low, high in byte_slices([t.encode("utf-8", "replace") for t in texts]):
                rows, has_letter = features(texts[low:high], width)
                keep = pa.array(np.nonzero(has_letter)[0] + low)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(keep), pa.array([r.tobytes() for r in rows[has_letter]], pa.binary())],
                    ["label", "row"],
                )

    sample = picked.select("label", "text").mapInArrow(made, "label string, row binary").collect()
    if not sample:
        return Model([], np.zeros((0, 1)), np.zeros((width, 1)), np.zeros(1), width)
    sample.sort(key=lambda r: (r.label, bytes(r.row)))
    labels = sorted({r.label for r in sample})
    rows = np.frombuffer(b"".join(bytes(r.row) for r in sample), np.float32).reshape(len(sample), width)
    codes = codewords(len(labels))
    target = codes[[labels.index(r.label) for r in sample]]
    # Every label weighs the same, however many texts it has.
    counts = np.unique([labels.index(r.label) for r in sample], return_counts=True)[1]
    weight = np.sqrt(1 / counts[[labels.index(r.label) for r in sample]])
    full = np.hstack((rows, np.ones((len(rows), 1), np.float32))) * weight[:, None].astype(np.float32)
    kernel = (full @ full.T).astype(np.float64)
    kernel[np.diag_indices_from(kernel)] += ridge / len(labels) / 100
    solved = full.T @ np.linalg.solve(kernel, target * weight[:, None])
    return Model(labels, codes, solved[:-1], solved[-1], width)


def predicted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """(row, lang_pred, score, ambiguous): a struct of all columns of `docs`, and the prediction for its text."""
    source = docs.select(docs[text_col].alias("text"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    schema = T.StructType(
        [
            source.schema["row"],
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("ambiguous", T.BooleanType()),
        ]
    )

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(0).to_pylist()
            sizes = [(t or "").encode("utf-8", "replace") for t in texts]
            names, scores, flags = [], [], []
            for low, high in byte_slices(sizes, 1 << 19):
                for at in range(low, high, 512):
                    name, score, flag = model.predict(texts[at : min(at + 512, high)])
                    names += name
                    scores += score.tolist()
                    flags += flag.tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(flags, pa.bool_())],
                schema.fieldNames(),
            )

    return source.mapInArrow(run, schema)


def held_out(id_col: Column) -> Column:
    """Whether crc32 of the id as text is 0 modulo 5; a null id is held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def language_predictions(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", **options
) -> DataFrame:
    """(id, held_out, lang_pred, score, ambiguous) per row of `docs`, learned from the rows that aren't held out.

    The model sees texts alone. A null text, or one without a letter, is
    `und` with score 0; so is everything where no label is known. Copies get
    the same prediction; a null id is held out. Other columns aren't read.
    """
    source = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), docs[label_col].alias("label"))
    model = fit(source.filter(~held_out(F.col("id"))), "text", "label", **options)
    rows = predicted(source.select("id", "text"), model)
    return rows.select(
        F.col("row.id").alias(id_col), held_out(F.col("row.id")).alias("held_out"), "lang_pred", "score", "ambiguous"
    )


def keep_identified(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
    least_score: float = 0.5,
    wanted: list[str] | None = None,
    **options,
) -> DataFrame:
    """The rows of `docs` in a known language, with all their columns.

    Texts that are `und`, or whose best codeword has a score under
    `least_score`, go, and with `wanted` those of other languages.
    """
    model = fit(docs.filter(~held_out(docs[id_col])), text_col, label_col, **options)
    rows = predicted(docs, model, text_col).filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score))
    if wanted is not None:
        rows = rows.filter(F.col("lang_pred").isin(wanted))
    return rows.select(*[F.col(f"row.`{c}`") for c in docs.columns])
