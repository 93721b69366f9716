"""Toxicity: cumulative-link ordinal regression over sparse text features.

``P(grade <= k | x) = sigmoid(theta_k - w.x)``: one weight vector shared by all ordered thresholds
``theta_1 < theta_2 < ...``. The score is the expected severity, the sum over k of ``P(grade >= k)``.

Features are the presence of a word, and of a word's first four bytes (stems of inflected forms).
The model is fitted on a bounded sample of labelled rows (``sample_rows``, the ids of smallest hash);
the features are chosen by a distributed likelihood-ratio test over that sample, and every document
is then scored on its whole text by one projection without a shuffle.

Defined cases: a null or empty text has no feature and gets the base rate; labels with a null id or
grade are left out; several labels of one document count as their highest, and several texts of one id
as the smallest of them; repeated rows are scored each, by their own text; without labels, or with a
single grade, every document has severity 0 and is not toxic; a text of any length is read whole; an
empty table gives no rows; columns of the input named like the results are replaced, others kept.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustloom.llm.common import discard, materialize
from trustloom.llm.words import ALNUM

SAMPLE_ROWS = 8000
MAX_FEATURES = 2000
STEM_BYTES = 4


def features(text: str | None) -> set[bytes]:
    """Words of the lower-cased text, and with a leading 0x00 the first bytes of longer ones."""
    words = set(text.lower().encode().translate(ALNUM).split()) if text else set()
    return words | {b"\0" + w[:STEM_BYTES] for w in words if len(w) > STEM_BYTES}


@dataclass
class OrdinalModel:
    """Shared weights and ordered thresholds; grades are 0 to ``len(thresholds)``."""

    weights: dict[bytes, float] = field(default_factory=dict)
    thresholds: list[float] = field(default_factory=list)

    def exceed(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) by row and k."""
        theta = np.asarray(self.thresholds, dtype=float)
        return 1 / (1 + np.exp(np.clip(theta[None, :] - scores[:, None], -500, 500)))

    def raw(self, texts: list[str | None]) -> np.ndarray:
        w = self.weights
        whole = {k for k in w if k[:1] != b"\0"}
        stems = {k[1:] for k in w if k[:1] == b"\0"}
        out = np.zeros(len(texts))
        for i, text in enumerate(texts):
            if text:
                words = set(text.lower().encode().translate(ALNUM).split())
                s = sum(w[x] for x in words & whole)
                heads = {x[:STEM_BYTES] for x in words if len(x) > STEM_BYTES}
                out[i] = s + sum(w[b"\0" + x] for x in heads & stems)
        return out


def fit_ordinal(rows: list[list[int]], grades: np.ndarray, n_features: int, n_grades: int, ridge: float = 0.02, rounds: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of maximum penalised likelihood, by Adam on (w, theta_1, log gaps)."""
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    cols = np.fromiter((c for r in rows for c in r), dtype=np.int64, count=len(of))
    n, k = len(rows), n_grades - 1
    w = np.zeros(n_features)
    share = np.array([(grades >= j + 1).mean() for j in range(k)]).clip(1e-4, 1 - 1e-4)
    theta0 = np.log((1 - share) / share)
    gaps = np.log(np.maximum(np.diff(theta0), 0.05))
    p = np.concatenate([w, theta0[:1], gaps])
    m, v = np.zeros_like(p), np.zeros_like(p)
    sig = lambda x: 1 / (1 + np.exp(-np.clip(x, -60, 60)))
    for t in range(1, rounds + 1):
        w, theta = p[:n_features], np.concatenate([p[n_features : n_features + 1], np.exp(p[n_features + 1 :])]).cumsum()
        s = np.bincount(of, weights=w[cols], minlength=n) if len(cols) else np.zeros(n)
        # P(y = g) = F(theta_{g+1} - s) - F(theta_g - s), with F(-inf) = 0 and F(inf) = 1
        f = np.column_stack([np.zeros(n), sig(theta[None, :] - s[:, None]), np.ones(n)])
        d = f * (1 - f)
        i = np.arange(n)
        pr = np.maximum(f[i, grades + 1] - f[i, grades], 1e-12)
        up, low = d[i, grades + 1] / pr, d[i, grades] / pr
        gs = up - low  # of the negative log likelihood by the score
        gt = np.zeros(k)
        for j in range(k):  # by theta_{j+1}
            gt[j] = -(up[grades == j].sum() - low[grades == j + 1].sum())
        gw = np.bincount(cols, weights=gs[of], minlength=n_features) + ridge * w
        tail = gt[::-1].cumsum()[::-1]
        g = np.concatenate([gw, tail[:1], tail[1:] * np.exp(p[n_features + 1 :])])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - 0.08 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return p[:n_features], np.concatenate([p[n_features : n_features + 1], np.exp(p[n_features + 1 :])]).cumsum()


def _likelihood_ratio(a, b, na, nb):
    """G-squared of a feature in ``a`` of ``na`` graded and ``b`` of ``nb`` ungraded rows; as a Column."""
    total, both = na + nb, a + b

    def part(o, row, col):
        return F.when(o > 0, o * F.log(o * total / (row * col))).otherwise(0.0)

    return 2 * (part(a, F.lit(na), both) + part(b, F.lit(nb), both) + part(na - a, F.lit(na), total - both) + part(nb - b, F.lit(nb), total - both))


def _lexicon(rows, pos: int, neg: int, a: str, b: str, least_g2: float, most: int) -> DataFrame:
    """Features of largest likelihood ratio, and whether they speak for a grade above 0."""
    scored = rows.withColumns({"g2": _likelihood_ratio(F.col(a), F.col(b), float(pos), float(neg)), "up": F.col(a) * neg > F.col(b) * pos})
    return scored.where((F.col(a) + F.col(b) >= 3) & (F.col("g2") >= least_g2)).orderBy(F.desc("g2"), "f").limit(most).select("f", "up")


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, max_features: int = MAX_FEATURES, least_g2: float = 15.0, grades_by_density: int = 0) -> OrdinalModel:
    """Fit on (doc_id, grade) labels. At most ``sample_rows`` labelled ids are used, each with one text (the smallest).

    ``grades_by_density``: for labels that only say toxic or not, so many severity grades are DERIVED for the
    toxic rows. The sample is halved by a hash of the id; each half's words that speak for toxicity are
    found from its labels alone, and a toxic row is graded by how many different words it holds that the OTHER
    half found: the words that grade a row were not chosen by looking at it. Quantiles of that number are the grades.
    """
    spark = docs.sparkSession
    graded = labels.where(F.col("doc_id").isNotNull() & F.col("grade").isNotNull()).groupBy("doc_id").agg(F.max("grade").cast("int").alias("grade"))
    sample = graded.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id")  # sample_rows is the bound
    rows = rows.groupBy("doc_id", "grade").agg(F.min("text").alias("text")).withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).cast("int"))

    def extract(batches):
        for batch in batches:
            found = [list(features(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("grade").cast(pa.int32()), batch.column("half"), pa.array(found, pa.list_(pa.binary()))], ["grade", "half", "features"])

    table, path = materialize(rows.select("grade", "half", "text").mapInArrow(extract, "grade int, half int, features array<binary>"), "labelled")
    n = {(r["half"], r["up"]): r["n"] for r in table.groupBy("half", (F.col("grade") > 0).alias("up")).agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = {(h, up): n.get((h, up), 0) for h in (0, 1) for up in (True, False)}
    pos, neg = sizes[0, True] + sizes[1, True], sizes[0, False] + sizes[1, False]
    if not pos or not neg:
        return OrdinalModel()
    count = lambda half, up: F.sum(((F.col("half") == half) & ((F.col("grade") > 0) == up)).cast("double"))
    counted = table.select("grade", "half", F.explode("features").alias("f")).groupBy("f").agg(*[count(h, up).alias(f"{'a' if up else 'b'}{h}") for h, up in sizes])
    counted, counted_path = materialize(counted.withColumns({"a": F.col("a0") + F.col("a1"), "b": F.col("b0") + F.col("b1")}), "features")
    chosen = [bytes(r["f"]) for r in _lexicon(counted, pos, neg, "a", "b", least_g2, max_features).collect()]
    at = {f: i for i, f in enumerate(chosen)}
    speak: list[set[bytes]] = [set(), set()]
    if grades_by_density > 1:
        for half in (0, 1):
            if sizes[half, True] and sizes[half, False]:
                found = _lexicon(counted, sizes[half, True], sizes[half, False], f"a{half}", f"b{half}", least_g2, max_features).where("up")
                speak[1 - half] = {bytes(r["f"]) for r in found.collect()}
    if not chosen:
        discard(spark, path, counted_path)
        return OrdinalModel()
    wanted = spark.sparkContext.broadcast((at, speak))

    def design(batches):
        for batch in batches:
            at, speak = wanted.value
            cols, held = [], []
            for fs, half in zip(batch.column("features").to_pylist(), batch.column("half").to_pylist(), strict=True):
                cols.append([at[f] for f in fs if f in at])
                held.append(sum(f in speak[half] for f in fs))
            yield pa.RecordBatch.from_arrays([batch.column("grade"), pa.array(held, pa.int32()), pa.array(cols, pa.list_(pa.int32()))], ["grade", "held", "cols"])

    got = table.mapInArrow(design, "grade int, held int, cols array<int>").collect()  # sample_rows at most
    discard(spark, path, counted_path)
    got.sort(key=lambda r: (r["grade"], r["held"], sorted(r["cols"])))
    rows_ = [sorted(r["cols"]) for r in got]
    grades = np.array([max(0, r["grade"]) for r in got])
    if grades_by_density > 1:
        held = np.array([r["held"] for r in got])
        cuts = np.quantile(held[grades > 0], np.linspace(0, 1, grades_by_density + 1)[1:-1])
        grades = np.where(grades > 0, 1 + (held[:, None] > cuts[None, :]).sum(axis=1), 0)
    levels = np.unique(grades)
    weights, theta = fit_ordinal(rows_, np.searchsorted(levels, grades), len(at), len(levels))
    return OrdinalModel({f: float(weights[i]) for f, i in at.items()}, [float(x) for x in theta])


def score(docs: DataFrame, model: OrdinalModel, cut: float = 0.5, keep_columns: bool = False) -> DataFrame:
    """expected_severity, p_toxic (P of grade 1 or more) and toxic (p_toxic >= cut) for every document.

    With ``keep_columns`` the result has all columns of ``docs`` and these three, which replace columns of
    their names.
    """
    known = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))
    made = ("expected_severity", "p_toxic", "toxic")
    names = [c for c in docs.columns if c.lower() not in made] if keep_columns else ["doc_id"]
    text_at = names.index("text") if keep_columns else 1
    source = docs.select(*[F.col(f"`{c}`") for c in names]).withColumn("text", F.col("text").cast("string")) if keep_columns else docs.select("doc_id", F.col("text").cast("string").alias("text"))

    def run(batches):
        model = OrdinalModel(*known.value)
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            if model.thresholds:
                exceed = model.exceed(model.raw(texts))
                severity, p = exceed.sum(axis=1), exceed[:, 0]
            else:
                severity = p = np.zeros(len(texts))
            new = [pa.array(severity, pa.float64()), pa.array(p, pa.float64()), pa.array(p >= cut, pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(names))] + new, [*names, "expected_severity", "p_toxic", "toxic"])

    fields = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in names)
    return source.mapInArrow(run, f"{fields}, expected_severity double, p_toxic double, toxic boolean")
