"""Operator 7: rates for documents whose soft domains then add up to target shares of tokens.

Everything is DataFrame expressions. A naive Bayes classifier, learnt from a labelled table, gives
each document a posterior over the domains. Projected gradient steps then fit a rate of 0 or more
for each document, so that the tokens expected of each domain come to its target. A step
moves a rate by what the document's posterior says alone, and posteriors are rounded to a grid; so
documents of one cell of the grid have one rate, and the steps run over cells.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docpipe.llm.common import WORD, fresh, kept, table, text_of

#: What is counted in a text, as patterns; all other characters are counted together.
FEATURES = (
    "[#*$%&|<>=_{}\\[\\]]",
    "[0-9]",
    "[äöüß]",
    "[éèêçàù]",
    "[áíóúñ]",
    "[Tt]h|nd|sh|ing",
    "ch|ei|lich",
    "eau|eux|ou|qu",
    "ci|ad[oa]|os",
)
#: So many characters' worth of evidence counts: less makes memberships softer.
EVIDENCE = 60.0
#: Posteriors are rounded to whole parts of so many.
GRID = 20
STEPS = 60
#: Target shares of tokens of the query and the pipeline: languages, and what is labelled as poor.
TARGETS = {"en": 0.40, "de": 0.20, "es": 0.15, "fr": 0.20, "poor": 0.05}


def counted(docs: DataFrame, text: str = "text", name: str = "counts") -> DataFrame:
    """`docs` with `n_tokens` (words) and `counts`: of each feature, then of all other characters."""
    content = text_of(text)
    hits = [F.regexp_count(content, F.lit(p)).cast("double") for p in FEATURES]
    rest = F.greatest(F.lit(0.0), F.length(content) - sum(hits[1:], hits[0]))
    return docs.withColumns(
        {"n_tokens": F.regexp_count(content, F.lit(WORD)).cast("long"), name: F.array(*hits, rest)}
    )


def classifier(labelled: DataFrame, domains: list[str]) -> list[tuple[str, float, list[float]]]:
    """Name, log prior and log rates of features of each domain that has rows (`domain`, `counts`).

    One row of fixed length for each of `domains` comes to the driver.
    """
    size = len(FEATURES) + 1
    sums = [F.sum(F.col("counts")[k]).alias(f"c{k}") for k in range(size)]
    rows = labelled.where(F.col("domain").isin(domains)).groupBy("domain")
    rows = rows.agg(F.count("*").alias("n"), *sums).sort("domain")
    total = [sum((F.col(f"c{k}") for k in range(1, size)), F.col("c0")) + float(size)]
    rates = [F.log((F.col(f"c{k}") + 1.0) / total[0]) for k in range(size)]
    found = rows.select("domain", F.log("n").alias("prior"), F.array(*rates).alias("rates")).collect()
    return [(r["domain"], r["prior"], list(r["rates"])) for r in found]


def posterior(model: list[tuple[str, float, list[float]]], counts: Column) -> Column:
    """The posterior of each domain of the model, in whole parts of GRID or so."""
    size = F.aggregate(counts, F.lit(0.0), lambda s, c: s + c)
    # evidence of long texts counts as that of EVIDENCE characters, so that no text is all one domain
    scale = F.least(F.lit(1.0), F.lit(EVIDENCE) / F.greatest(size, F.lit(1.0)))
    scores = [
        F.lit(prior) + scale * sum((counts[k] * rate for k, rate in enumerate(rates)), F.lit(0.0))
        for _, prior, rates in model
    ]
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    parts = [F.exp(s - best) for s in scores]
    whole = sum(parts[1:], parts[0])
    return F.array(*[F.round(F.lit(float(GRID)) * p / whole).cast("int") for p in parts])


def _shares(cell: Column) -> Column:
    total = F.aggregate(cell, F.lit(0), lambda s, q: s + q)
    return F.transform(cell, lambda q: q / total)


def _rate(steps: list[list[float]], shares: Column) -> Column:
    """The rate and the one before after all steps: each is a momentum, then a slope for each domain."""
    start = F.struct(F.lit(1.0).alias("now"), F.lit(1.0).alias("before"))
    if not steps:
        return start

    def move(state: Column, step: Column) -> Column:
        ahead = state["now"] + step[0] * (state["now"] - state["before"])
        slope = F.aggregate(
            F.zip_with(shares, F.slice(step, 2, F.size(shares)), lambda p, g: p * g), F.lit(0.0), lambda s, x: s + x
        )
        return F.struct(F.greatest(F.lit(0.0), ahead - slope).alias("now"), state["now"].alias("before"))

    return F.aggregate(F.array(*[F.array(*[F.lit(float(x)) for x in s]) for s in steps]), start, move)


def fit(cells: DataFrame, targets: list[float], steps: int = STEPS, close: float = 1e-4) -> list[list[float]]:
    """Steps that take all rates from 1 to where the domains' expected tokens are the targets.

    `cells` has `cell` and `n_tokens`. This is accelerated projected gradient descent for the sum
    over domains of (expected - target)^2 / (tokens of the domain at rate 1), in the metric of a
    document's tokens: a step of 1 is then as long as is safe, since posteriors add up to 1. Ends
    after `steps` or when no domain is off by more than `close` of all tokens. One number for each
    domain comes to the driver in each step.
    """
    shares = _shares(F.col("cell"))
    size = len(targets)

    def expected(rate: Column) -> list[float]:
        sums = [F.sum(F.col("n_tokens") * shares[k] * rate).alias(f"d{k}") for k in range(size)]
        return [float(x or 0) for x in cells.agg(*sums).first()]

    mass = expected(F.lit(1.0))
    total = sum(mass)
    done: list[list[float]] = []
    for k in range(steps):
        momentum = k / (k + 3)
        state = _rate(done, shares)
        ahead = state["now"] + F.lit(momentum) * (state["now"] - state["before"])
        now = expected(ahead)
        off = [x - t * total for x, t in zip(now, targets, strict=True)]
        if max(map(abs, off), default=0) <= close * total:
            break
        done.append([momentum, *[x / m if m else 0.0 for x, m in zip(off, mass, strict=True)]])
    return done


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], steps: int = STEPS) -> DataFrame:
    """`docs` with `n_tokens`, `domain` (the likeliest), `rate` and `copies`.

    `labelled` has `doc_id` and `domain` of some rows of `docs`; `targets` the share of tokens that each domain is to have
    of as many tokens as there are. `rate` is how often a document should be used, 0 or more;
    `copies` rounds it up or down by a hash of id and text, so that its mean is the rate, over rows of
    equal texts too; only rows that have both the same are rounded alike. Domains
    without labelled rows drop out and the other targets are scaled up; without any all rates are 1
    and domains null. An id that `labelled` has twice counts with its least domain. Null texts are empty and get the rate of the priors. A null or unknown
    domain teaches nothing. Repeated rows get equal rates; every row stays, also at rate 0.
    Columns with the new names are replaced; empty tables stay empty. At most
    (GRID + 1) ** domains cells are possible; they are joined as a table, not as literals.
    """
    counts, cell = fresh(docs, "counts"), fresh(docs, "cell")
    features = kept(counted(docs, name=counts), "mixing-features")
    known = labelled.groupBy("doc_id").agg(F.min("domain").alias("domain"))
    taught = features.select("doc_id", F.col(counts).alias("counts")).join(known, "doc_id")
    model = classifier(taught, list(targets))
    if not model:
        return features.drop(counts).withColumns(
            {"domain": F.lit(None).cast("string"), "rate": F.lit(1.0), "copies": F.lit(1)}
        )
    celled = features.withColumn(cell, posterior(model, F.col(counts))).drop(counts)
    cells = celled.groupBy(F.col(cell).alias("cell")).agg(F.sum("n_tokens").alias("n_tokens"))
    cells = kept(cells, "mixing-cells")
    wanted = [max(0.0, targets[name]) for name, _, _ in model]
    wanted = [w / sum(wanted) if sum(wanted) else 1 / len(wanted) for w in wanted]
    taken = fit(cells, wanted, steps)
    rated = cells.select(
        F.col("cell").alias(cell), F.round(_rate(taken, _shares(F.col("cell")))["now"], 6).alias("rate")
    )
    names = F.array(*[F.lit(name) for name, _, _ in model])
    place = F.array_position(cell, F.array_max(cell)).cast("int")
    # a cell may hold most documents; its rate is one short row
    joined = celled.drop("rate").join(rated, cell)
    uniform = F.pmod(F.xxhash64("doc_id", text_of(), F.lit("copies")), F.lit(1 << 30)) / float(1 << 30)
    up = F.when(uniform < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    return joined.withColumns(
        {"domain": F.element_at(names, place), "copies": (F.floor("rate") + up).cast("int")}
    ).drop(cell)


def labelled_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`doc_id` and `domain` of labelled documents: their language, or poor where the label says so."""
    marks = labels.groupBy("doc_id").agg(F.min("quality").alias("least"))
    domain = F.when(F.col("least") == 0, "poor").otherwise(F.col("lang"))
    return docs.select("doc_id", "lang").join(marks, "doc_id").select("doc_id", domain.alias("domain"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mix(docs, labelled_domains(docs, table(spark, sf_dir, "labels")), TARGETS)
    return mixed.select("doc_id", "n_tokens", "domain", "rate", "copies")
