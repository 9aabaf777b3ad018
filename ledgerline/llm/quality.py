"""Quality classifier: regularised quadratic discriminant over document statistics.

Every text becomes a vector of transformed statistics (word lengths, symbol,
case and digit shares, repetition ...).  Each class gets a mean and a
covariance shrunk towards the pooled one and its diagonal; the score is the
difference of the two Gaussian log densities, from Mahalanobis distances with
Cholesky factors computed once, and the log prior, shifted to where the
training rows have the fewest errors.

The class moments are sums over all labelled training rows, added up by
Spark; the driver receives one number per class and matrix cell, and one
error count per cut.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import words
from ledgerline.llm.common import Scratch, crc_mod, pick, string_bytes, text_or_empty
from ledgerline.llm.neardup import slices

POOLED = 0.2     # weight of the pooled covariance in each class's
DIAGONAL = 0.05  # weight of the diagonal
PRIOR_WORDS = 4.0  # shares of short texts are drawn to the value below as if so many words had it
TEMPERATURE = 4.0  # spreads the score over (0, 1); it moves no document across 0.5

CUTS = np.linspace(-40.0, 40.0, 321)  # cuts of the logit that the calibration tries

FEATURES = ("log_words", "log_word_bytes", "word_bytes_spread", "short_words", "symbols", "upper", "digits",
            "marks", "exclamations", "bars", "repeats", "distinct", "distinct_shingles", "top_word", "lines",
            "non_ascii", "doubled_marks")


def _mask(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_SYMBOL = _mask("#$%&*<>{}[]\\/@=+_~^`|")
_UPPER = _mask("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _UPPER | _mask("abcdefghijklmnopqrstuvwxyz")
_DIGIT = _mask("0123456789")
_MARK = _mask(".,;:?!")


def statistics(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, features) of a block of texts; a text without words has the values of an average one."""
    texts = len(offsets) - 1

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)

    starts, ends, counts = words.word_spans(flat, offsets)
    hashes, _ = words.word_hashes(flat, offsets)
    length = (ends - starts).astype(float)
    owner = np.repeat(np.arange(texts), counts)
    n = counts.astype(float)
    size = np.maximum(np.diff(offsets), 1).astype(float)

    def over_words(x: np.ndarray) -> np.ndarray:
        return np.bincount(owner, weights=x, minlength=texts)

    def share(count: np.ndarray, total: np.ndarray, usual: float, prior: float = PRIOR_WORDS) -> np.ndarray:
        return np.sqrt((count + prior * usual) / (total + prior))

    letters = per_text(_LETTER[flat])
    mean = (over_words(length) + 4 * PRIOR_WORDS) / (n + PRIOR_WORDS)
    spread = (over_words(np.abs(length - mean[owner])) + 2 * PRIOR_WORDS) / (n + PRIOR_WORDS)
    same = np.zeros(len(hashes))
    if len(hashes) > 1:
        same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    # Occurrences of each distinct word of each text.
    order = np.lexsort([hashes, owner])
    h, o = hashes[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(h)))
    distinct = np.bincount(o[first], minlength=texts).astype(float)
    top = np.zeros(texts)
    np.maximum.at(top, o[first], times)
    _, sets = words.shingle_sets(hashes, counts, 5)
    grams = np.where(counts >= 5, n - 4, (n > 0).astype(float))
    mark = _MARK[flat]
    doubled = np.zeros(len(flat), bool)
    if len(flat) > 1:
        doubled[1:] = mark[1:] & (flat[1:] == flat[:-1])
    alone = (length == 1) & (flat[starts] == ord("|")) if len(starts) else np.zeros(0, bool)
    out = np.column_stack([
        np.log1p(n), np.log(mean), np.log(spread),
        share(over_words(length <= 3), n, 0.3),
        share(per_text(_SYMBOL[flat]), size, 0.0, 8.0),
        share(per_text(_UPPER[flat]), letters, 0.03, 16.0),
        share(per_text(_DIGIT[flat]), size, 0.005, 16.0),
        share(per_text(mark), size, 0.03, 16.0),
        share(per_text(flat == ord("!")), size, 0.0, 8.0),
        share(over_words(alone), n, 0.0),
        share(over_words(same), n, 0.01),
        # Distinct words against what a text of that length usually has.
        np.log((distinct + PRIOR_WORDS) / (n + PRIOR_WORDS) ** 0.85),
        share(grams - sets, grams, 0.0),
        share(top, n, 0.1),
        share(per_text(flat == ord("\n")), n, 0.02),
        share(per_text(flat >= 128), size, 0.02, 16.0),
        share(per_text(doubled), size, 0.0, 8.0),
    ])
    return out


def text_features(column) -> np.ndarray:
    """Features of an Arrow string column without NULLs."""
    flat, offsets = string_bytes(column)
    parts = [statistics(flat[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a]) for a, b in slices(offsets)]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


def features(rows: DataFrame) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, x`` (array of features)."""

    def build(batches):
        import pyarrow as pa

        for batch in batches:
            x = text_features(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1])
                 .cast(pa.list_(pa.float64()))], names=["doc_id", "x"])

    return rows.mapInArrow(build, "doc_id bigint, x array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors, log determinants and log priors of classes 0 and 1."""

    means: np.ndarray
    factors: np.ndarray
    log_dets: np.ndarray
    log_priors: np.ndarray
    shift: float = 0.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        density = [self.log_priors[c] - 0.5 * self.log_dets[c]
                   - 0.5 * (((x - self.means[c]) @ self.factors[c].T) ** 2).sum(axis=1) for c in (0, 1)]
        return density[1] - density[0] + self.shift

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(np.clip(-self.logit(x) / TEMPERATURE, -700, 700)))

    def calibrated(self, errors: np.ndarray) -> "Discriminant":
        """Moves the decision to the cut with the fewest errors (the middle of the widest such run of cuts)."""
        best = np.flatnonzero(errors == errors.min())
        runs = np.split(best, np.flatnonzero(np.diff(best) > 1) + 1)
        run = max(runs, key=len)
        return replace(self, shift=-float(CUTS[run].mean()))

    @classmethod
    def fit(cls, n: np.ndarray, sums: np.ndarray, squares: np.ndarray) -> "Discriminant":
        """From class counts, sums and sums of outer products.

        A class without rows gets the other's moments, so the score is 0.5
        throughout; without any rows all moments are standard.
        """
        d = sums.shape[1]
        total = n.sum()
        if total == 0:
            return cls(np.zeros((2, d)), np.stack([np.eye(d)] * 2), np.zeros(2), np.zeros(2))
        means = np.array([sums[c] / n[c] if n[c] else sums.sum(axis=0) / total for c in (0, 1)])
        within = [squares[c] - n[c] * np.outer(means[c], means[c]) if n[c] else np.zeros((d, d)) for c in (0, 1)]
        pooled = (within[0] + within[1]) / total + 1e-9 * np.eye(d)
        factors, dets = [], []
        for c in (0, 1):
            own = within[c] / n[c] if n[c] > d else pooled
            cov = (1 - POOLED) * own + POOLED * pooled
            cov = (1 - DIAGONAL) * cov + DIAGONAL * np.diag(np.diag(cov)) + 1e-6 * np.eye(d)
            low = np.linalg.cholesky(cov)
            factors.append(np.linalg.inv(low))
            dets.append(2 * np.log(np.diag(low)).sum())
        prior = np.log((n + 1.0) / (total + 2.0)) if n.all() else np.zeros(2)
        return cls(means, np.array(factors), np.array(dets), prior)


def fit(labelled: DataFrame) -> Discriminant:
    """``x, label`` (0 or 1) -> the model; one pass, all rows."""
    d = len(FEATURES)

    def moments(batches):
        import pyarrow as pa

        n, sums, squares = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, d)
            y = batch.column(1).to_numpy()
            for c in (0, 1):
                own = x[y == c]
                n[c] += len(own)
                sums[c] += own.sum(axis=0)
                squares[c] += own.T @ own
        cells = np.concatenate([n, sums.ravel(), squares.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells), dtype=np.int32)), pa.array(cells)],
                                         names=["cell", "value"])

    rows = (labelled.select("x", F.col("label").cast("int")).mapInArrow(moments, "cell int, value double")
            .groupBy("cell").agg(F.sum("value").alias("value")).collect())  # 2 + 2 d + 2 d**2 numbers
    cells = np.zeros(2 + 2 * d + 2 * d * d)
    for r in rows:
        cells[r["cell"]] = r["value"]
    model = Discriminant.fit(cells[:2], cells[2: 2 + 2 * d].reshape(2, d), cells[2 + 2 * d:].reshape(2, d, d))
    if not cells[:2].all():
        return model

    def misses(batches):
        import pyarrow as pa

        errors = np.zeros(len(CUTS))
        for batch in batches:
            logit = model.logit(batch.column(0).flatten().to_numpy().reshape(batch.num_rows, d))
            y = batch.column(1).to_numpy()
            errors += np.searchsorted(np.sort(logit[y == 0]), CUTS, side="left") * -1 + (y == 0).sum()
            errors += np.searchsorted(np.sort(logit[y == 1]), CUTS, side="left")
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(CUTS), dtype=np.int32)), pa.array(errors)],
                                         names=["cut", "errors"])

    rows = (labelled.select("x", F.col("label").cast("int")).mapInArrow(misses, "cut int, errors double")
            .groupBy("cut").agg(F.sum("errors").alias("errors")).collect())  # one number per cut
    return model.calibrated(np.array([r["errors"] for r in sorted(rows, key=lambda r: r["cut"])]))


def training_labels(labels: DataFrame, *, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """``doc_id, label`` of the training rows: crc32 of the id as text, modulo 3, is not 1.

    Rows without id or label are left out; several labels of one id: their
    mean, at least one half for 1.
    """
    rows = pick(labels, doc_id=id_col, label=label_col).filter("doc_id IS NOT NULL AND label IS NOT NULL")
    return (rows.filter(crc_mod("doc_id", 3) != 1).groupBy("doc_id")
            .agg((F.avg("label") >= 0.5).cast("int").alias("label")))


def train_on_labelled(docs: DataFrame, labels: DataFrame, scratch: Scratch, *, id_col: str = "doc_id",
                      text_col: str = "text") -> Discriminant:
    """The model, from the features of the labelled training rows alone."""
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("text", text_or_empty("text"))
    marked = training_labels(labels)
    x = scratch.save(features(rows.join(marked.select("doc_id"), "doc_id", "left_semi")), "features")
    model = fit(x.join(marked, "doc_id"))
    scratch.drop(x)
    return model


def train(docs: DataFrame, labels: DataFrame, scratch: Scratch, *, id_col: str = "doc_id", text_col: str = "text"
          ) -> tuple[Discriminant, DataFrame]:
    """(model, saved ``doc_id, x`` of all documents)."""
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("text", text_or_empty("text"))
    x = scratch.save(features(rows), "features")
    return fit(x.join(training_labels(labels), "doc_id")), x


def score_documents(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text"
                    ) -> DataFrame:
    """``doc_id, held_out, score, predicted``: one row per document.

    NULL text: empty.  A NULL id is scored, and counts as not held out unless
    the checksum of empty text says so.  Ties and repeated rows: equal texts
    have equal scores.  Empty table: no rows.  No label, language, source or
    id enters a score.
    """
    model, x = train(docs, labels, Scratch(docs.sparkSession, "quality"), id_col=id_col, text_col=text_col)

    def apply(batches):
        import pyarrow as pa

        for batch in batches:
            score = model.score(batch.column(1).flatten().to_numpy().reshape(batch.num_rows, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc_id", "score"])

    scored = x.mapInArrow(apply, "doc_id bigint, score double")
    return scored.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def score_column(model: Discriminant, text_col: str = "text"):
    """A column with each text's score, computed where the row is."""

    @F.arrow_udf("double")
    def score(text):
        import pyarrow as pa

        return pa.array(model.score(text_features(text)))

    return score(text_or_empty(text_col))
