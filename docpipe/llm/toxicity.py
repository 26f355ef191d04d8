"""Operator 3: a toxicity classifier learnt from confirmed examples and unlabelled text."""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docpipe.llm.common import attach, settle, table, text_of

#: Weights of the classifier; the hash of a word, or of its beginning, names one.
SIZE = 1 << 18
#: The classifier is fitted on about this many confirmed and unlabelled documents at most.
MOST_POSITIVE, MOST_UNLABELLED = 3_000, 9_000
_MARKS = b".,;:!?\"'()[]*#%&$|<>-"


class Features(dict):
    """Word to the numbers of its weights: its own and those of its first characters.

    ASCII letters count in either case and marks around words don't. Forgets all words when there
    are too many.
    """

    PREFIXES = (4, 5, 6, 7)

    def __init__(self, most: int = 150_000):
        self.most = most

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= self.most:
            self.clear()
        text = word.strip(_MARKS).decode()
        parts = [text] if text else []
        parts += [f"{text[:k]}*" for k in self.PREFIXES if len(text) > k]
        found = tuple(xxhash.xxh3_64_intdigest(p) % SIZE for p in parts)
        self[word] = found
        return found

    def of(self, text: str) -> np.ndarray:
        """The numbers of all different words and beginnings of words of a text."""
        words = set(text.encode().lower().split())
        found = set().union(*map(self.__getitem__, words))
        return np.sort(np.fromiter(found, np.int32, len(found)))


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def score(self, numbers: np.ndarray) -> float:
        z = self.bias + float(self.weights[numbers].sum(dtype=np.float64))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def telling(positive: list[np.ndarray], unlabelled: list[np.ndarray], least: float) -> np.ndarray:
    """The weights whose words are `least` standard errors more or less usual among the positives."""
    n, m = len(positive), len(unlabelled)
    shares = []
    for rows in (positive, unlabelled):
        seen = np.zeros(SIZE)
        for numbers in rows:
            seen[numbers] += 1
        shares.append(seen / len(rows))
    of_p, of_u = shares
    pooled = (n * of_p + m * of_u + 1) / (n + m + 2)
    return np.abs(of_p - of_u) > least * np.sqrt(pooled * (1 - pooled) * (1 / n + 1 / m))


def slopes(theta: np.ndarray, positive: tuple, unlabelled: tuple, prior: float) -> tuple[float, np.ndarray]:
    """R_U(-) - prior * R_P(-), and the slope of the risk at `theta`, whose last entry is the bias.

    Both sides are (row of each weight, weight, number of rows). Where the first is negative, the
    slope is that of its negative, so that a step down the slope raises it.
    """

    def sigmoid(z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    (own_p, at_p, n_p), (own_u, at_u, n_u) = positive, unlabelled
    z_p = theta[-1] + np.bincount(own_p, theta[at_p], n_p)
    z_u = theta[-1] + np.bincount(own_u, theta[at_u], n_u)
    negative = np.logaddexp(0, z_u).mean() - prior * np.logaddexp(0, z_p).mean()
    # derivatives of the two parts by z
    plus = -prior * sigmoid(-z_p) / n_p
    minus_u, minus_p = sigmoid(z_u) / n_u, -prior * sigmoid(z_p) / n_p
    by_p, by_u = (plus + minus_p, minus_u) if negative >= 0 else (-minus_p, -minus_u)
    slope = np.empty_like(theta)
    slope[:-1] = np.bincount(at_p, by_p[own_p], len(theta) - 1) + np.bincount(at_u, by_u[own_u], len(theta) - 1)
    slope[-1] = by_p.sum() + by_u.sum()
    return float(negative), slope


def fit(
    positive: list[np.ndarray],
    unlabelled: list[np.ndarray],
    prior: float,
    steps: int = 400,
    rate: float = 0.1,
    shrink: float = 3e-4,
    least: float = 5.0,
) -> Model:
    """Minimise the non-negative positive-unlabelled risk of a linear model by Adam.

    With logistic losses the risk is prior * R_P(+) + max(0, R_U(-) - prior * R_P(-)): what the
    positives hidden in the unlabelled add to R_U(-) is taken off. Where the second part is
    negative, the step goes up that part only, as it is then fitted too closely. Only `telling`
    words have weights, held small by `shrink`. Without positives all scores are the prior.
    """
    logit = float(np.log(prior / (1 - prior))) if 0 < prior < 1 else -30.0
    weights = np.zeros(SIZE, np.float32)
    if not positive or not unlabelled or not 0 < prior < 1:
        return Model(weights, logit)
    known = np.flatnonzero(telling(positive, unlabelled, least))

    place = np.full(SIZE, -1, np.int32)
    place[known] = np.arange(len(known))

    def rows(found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
        places = [(p := place[numbers])[p >= 0] for numbers in found]
        owner = np.repeat(np.arange(len(found)), [len(p) for p in places])
        return owner, np.concatenate(places), len(found)

    confirmed, others = rows(positive), rows(unlabelled)
    theta = np.append(np.zeros(len(known)), logit)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for taken in range(1, steps + 1):
        slope = slopes(theta, confirmed, others, prior)[1]
        slope[:-1] += shrink * theta[:-1]
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        ahead = first / (1 - 0.9**taken)
        theta -= rate * ahead / (np.sqrt(second / (1 - 0.999**taken)) + 1e-7)
    weights[known] = theta[:-1]
    return Model(weights, float(theta[-1]))


def held_out(doc_id: Column) -> Column:
    """Whether the labels of a row are kept for checks; a null id counts as no."""
    fold = F.crc32(doc_id.cast("string").cast("binary")) % 5
    return F.coalesce(fold == 0, F.lit(False))


def _sampled(key: Column, share: float) -> Column:
    """About that share of the keys, always the same ones."""
    return F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) < int(min(1.0, share) * (1 << 30))


def _numbers(rows: DataFrame) -> list[np.ndarray]:
    """The features of a bounded sample, by id; they are all that comes to the driver."""

    def compute():
        features = Features()

        def step(batch: pa.RecordBatch) -> list:
            packed = [features.of(t.as_py()).tobytes() for t in batch.column(0)]
            return [pa.array(packed, pa.binary())]

        return step

    fields = [T.StructField("numbers", T.BinaryType())]
    found = attach(rows.select("doc_id", "text"), {"text": text_of()}, fields, compute).toArrow()
    pairs = zip(found["doc_id"].to_pylist(), found["numbers"].to_pylist(), strict=True)
    return [np.frombuffer(packed, np.int32) for _, packed in sorted(pairs)]


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the rows that are not held out.

    Confirmed examples are documents whose label is toxic; the prior is their share of the labelled
    ones. Unlabelled text is any document, with its label, if there is one, not looked at. Of both,
    a sample by hash of the id comes to about MOST_POSITIVE and MOST_UNLABELLED rows; a label of
    an id that is there both ways counts as toxic. Rows with null ids or labels take no part.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    usable = usable.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n_labelled, n_toxic = usable.agg(F.count("*"), F.coalesce(F.sum(F.expr("int(toxic = 1)")), F.lit(0))).first()
    texts = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    n_texts = texts.select("doc_id").count()
    if not n_toxic or not n_texts:
        return fit([], [], n_toxic / n_labelled if n_labelled else 0.0)
    toxic = usable.where(F.col("toxic") == 1)
    picked = toxic.where(_sampled(F.col("doc_id"), MOST_POSITIVE / n_toxic)).select("doc_id")
    # at most about MOST_POSITIVE ids of eight bytes
    positive = _numbers(texts.join(F.broadcast(picked), "doc_id"))
    unlabelled = _numbers(texts.where(_sampled(F.col("doc_id"), MOST_UNLABELLED / n_texts)))
    model = fit(positive, unlabelled, n_toxic / n_labelled)
    del positive, unlabelled
    settle(docs.sparkSession)
    return model


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """`docs` with `score`, or another `name`, from the whole text alone: 0 to 1, higher for toxic. Null is empty.

    An empty text has the score of the model's bias. Repeated rows are scored each; a column
    of `docs` with that name is replaced; an empty table stays empty. The model has SIZE weights.
    """

    def compute():
        features = Features()

        def step(batch: pa.RecordBatch) -> list:
            found = (features.of(t.as_py()) for t in batch.column(0))
            return [pa.array([model.score(x) for x in found], pa.float64())]

        return step

    return attach(docs, {"text": text_of(text)}, [T.StructField(name, T.DoubleType())], compute)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, learn(docs, table(spark, sf_dir, "labels")))
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)
