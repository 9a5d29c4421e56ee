"""URL filter: rules first, and for the rest the ratio of two character language models.

Rules allow or block a host with its subdomains under a path. The URLs they settle are the examples: one model is learned
from the accepted ones, one from the rejected ones. What a rule itself looks at (its host, its path) is cut from its examples,
so that the models learn what else accepted and rejected URLs have, not the rules.

A model is a variable-order Markov model of bytes: the next byte given up to `ORDER` bytes before it, Witten-Bell smoothed
from each context to the next shorter one and at last to equal chances. A context is kept where it has at least one
`SUPPORT`-th of all bytes of its model, so contexts are long where the data bear them; the rule is the same at every size,
every example is counted, and a model never has more than SUPPORT contexts per order.

A URL scores the difference of both log-likelihoods per byte. The cut between block and allow is calibrated on every fifth
example, which the models do not see: it is where the mean of both error rates is least.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridledger.llm.common import give_back, in_batches

ALLOW, BLOCK = "allow", "block"
ORDER = 5
SUPPORT = 16_384
#: One example in so many is kept for the calibration.
HELD_OUT = 5
#: Scores are counted in bins of this width; those beyond the range lie in the outermost bins.
BIN, BINS = 1 / 256, 4096
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


#: Host and path of each rule, and what becomes of its URLs.
RULES = (
    Rule(BLOCK, "net", "/"),
    Rule(ALLOW, "example.net", "/en/"),
    Rule(BLOCK, "example.com", "/de/"),
    Rule(ALLOW, "org", "/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What lies after the first `://` up to the path, A-Z lower-cased, and from there up to query or fragment."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def with_rules(pages: DataFrame, url: str, rules: Sequence[Rule]) -> DataFrame:
    """Add `host`, `path`, `rule` (the longest that fits; of equal ones the first) and the rule's `ruled` verdict."""
    host, path = host_and_path(F.col(url))
    parted = pages.withColumns({"host": host, "path": path})
    longest_first = sorted(rules, key=lambda r: -len(r.name))
    picked = [
        F.when(r.fits(F.col("host"), F.col("path")), F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("ruled")))
        for r in longest_first
    ]
    found = F.coalesce(*picked) if picked else F.lit(None).cast("struct<rule: string, ruled: string>")
    return parted.withColumn("_by", found).select("*", "_by.rule", "_by.ruled").drop("_by")


def model_text(rules: Sequence[Rule]) -> Column:
    """What the models read of a URL: host and path, without what its rule has looked at."""
    seen = F.concat("host", "path")
    for r in rules:
        rest = F.concat(
            F.substring(F.col("host"), F.lit(1), F.length("host") - len(r.host)),
            F.lit("/"), F.substring(F.col("path"), F.lit(len(r.path) + 1), F.length("path")),
        )
        seen = F.when(F.col("rule") == r.name, rest).otherwise(seen)
    return seen


# -- byte contexts ------------------------------------------------------------------------------


def _spread(texts: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per byte of all texts: the byte, the bytes before it as one number (nearest lowest), how many there are, its text."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    row = np.repeat(np.arange(len(texts)), np.diff(offsets))
    before = np.minimum(np.arange(len(data)) - (offsets - offsets[0])[row], order) if len(data) else row
    context = np.zeros(len(data), np.int64)
    for k in range(1, order + 1):
        has = np.flatnonzero(before >= k)
        context[has] |= data[has - k].astype(np.int64) << (8 * (k - 1))
    return data, context, before, row


def _keys(context: np.ndarray, k: int, order: int) -> np.ndarray:
    """The number of the context of length k: its bytes, above them its length."""
    return (context & ((1 << (8 * k)) - 1)) | (k << (8 * order))


def _counter(order: int):
    """Over batches (is accepted, text): a task's counts of (model, context, next byte)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            give_back()
            data, context, before, row = _spread(batch.column(1), order)
            model = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)[row]
            for k in range(order + 1):
                has = np.flatnonzero(before >= k)
                keys = (_keys(context[has], k, order) << 9) | (model[has] << 8) | data[has]
                found, n = np.unique(keys, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found >> 8 & 1, pa.int32()), pa.array(found >> 9), pa.array(found & 255, pa.int32()), pa.array(n)],
                    names=["model", "context", "next", "n"],
                )

    return count


@dataclass(frozen=True)
class Model:
    """Kept contexts in order, each with its escape weight, and what each gives to each byte seen in it."""

    order: int
    contexts: np.ndarray
    escape: np.ndarray
    edges: np.ndarray
    share: np.ndarray

    def log_likelihood(self, data: np.ndarray, context: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Natural log of the chance of every byte after its context."""
        chance = np.full(len(data), 1 / 256)
        for k in range(self.order + 1):
            has = np.flatnonzero(before >= k)
            keys = _keys(context[has], k, self.order)
            at = np.searchsorted(self.contexts, keys)
            known = np.flatnonzero(at < len(self.contexts))
            known = known[self.contexts[at[known]] == keys[known]]
            if not len(known):
                break
            rows, at, edge = has[known], at[known], keys[known] << 8 | data[has[known]]
            to = np.minimum(np.searchsorted(self.edges, edge), len(self.edges) - 1)
            chance[rows] = self.escape[at] * chance[rows] + np.where(self.edges[to] == edge, self.share[to], 0.0)
        return np.log(chance)


def _model(rows: list, order: int) -> Model:
    """Witten-Bell: of n bytes after a context, d of them different, the shorter context has d parts of n + d."""
    rows = sorted(rows, key=lambda r: r.context)
    size = np.array([r.n for r in rows], np.float64)
    kinds = np.array([len(r.nexts) for r in rows], np.float64)
    edges = [(r.context << 8 | e.next, e.n / (r.n + len(r.nexts))) for r in rows for e in sorted(r.nexts)]
    return Model(
        order, np.array([r.context for r in rows], np.int64), kinds / np.maximum(size + kinds, 1),
        np.array([k for k, _ in edges], np.int64), np.array([s for _, s in edges], np.float64),
    )


def learn(examples: DataFrame, order: int = ORDER, support: int = SUPPORT) -> tuple[Model, Model]:
    """Models of the accepted and of the rejected texts, from `accepted boolean, text string`.

    Counts are of all examples, added up on the executors. The contexts that reach the driver have a support-th of their
    model's bytes each, hence at most `support` per order and model, with at most 256 next bytes.
    """
    counted = in_batches(examples).mapInArrow(_counter(order), "model int, context bigint, next int, n bigint")
    after = counted.groupBy("model", "context", "next").agg(F.sum("n").alias("n"))
    contexts = after.groupBy("model", "context").agg(
        F.sum("n").alias("n"), F.collect_list(F.struct("next", "n")).alias("nexts")
    )
    total = contexts.filter(F.col("context") == 0).select("model", F.col("n").alias("total"))  # the empty context
    kept = contexts.join(total, "model").filter(F.col("n") * support >= F.col("total")).drop("total").collect()
    accepted, rejected = (_model([r for r in kept if r.model == m], order) for m in (1, 0))
    return accepted, rejected


def ratios(texts: pa.Array, accepted: Model, rejected: Model) -> np.ndarray:
    """Log-likelihood under the accepted model less that under the rejected one, per byte; 0 for an empty text."""
    data, context, before, row = _spread(texts, accepted.order)
    each = accepted.log_likelihood(data, context, before) - rejected.log_likelihood(data, context, before)
    size = np.bincount(row, minlength=len(texts))
    return np.bincount(row, each, len(texts)) / np.maximum(size, 1)


def _scorer(accepted: Model, rejected: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            give_back()
            found = ratios(batch.column(1), accepted, rejected)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=["row", "ratio"])

    return score


def scored(df: DataFrame, models: tuple[Model, Model], text: str, name: str) -> DataFrame:
    """Add the ratio of the column `text`; the other columns pass through as they are."""
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != text]).alias("row"), text)
    kind = rows.schema["row"].dataType.simpleString()
    found = in_batches(rows).mapInArrow(_scorer(*models), f"row {kind}, ratio double")
    return found.select("row.*", F.col("ratio").alias(name))


def cut_between(accepted: dict[int, int], rejected: dict[int, int]) -> float:
    """Edge of bins with the least mean of both error rates: the share of accepted below it and of rejected from it on.

    Of equally good edges it is the middle one. Without examples of either kind the cut is 0.
    """
    good, bad = (np.array([of.get(b, 0) for b in range(BINS)], np.float64) for of in (accepted, rejected))
    if not good.sum() or not bad.sum():
        return 0.0
    lost = np.concatenate(([0.0], np.cumsum(good))) / good.sum()
    passed = 1 - np.concatenate(([0.0], np.cumsum(bad))) / bad.sum()
    edges = np.flatnonzero(np.isclose(lost + passed, (lost + passed).min(), atol=1e-12))
    return float((edges[len(edges) // 2] - BINS // 2) * BIN)


def judge(
    pages: DataFrame, *, url: str = "url", keep: Sequence[str] = ("page_id",), rules: Sequence[Rule] = RULES,
    order: int = ORDER, support: int = SUPPORT,
) -> DataFrame:
    """The columns `keep`, `host`, `path`, `rule` (NULL where none fits), `ratio` and `verdict` of every row.

    A NULL URL or one without `://` has an empty host and path and a ratio of 0. A ratio from the cut up is allowed. If the
    rules settle no URL as accepted, or none as rejected, nothing can be compared: ratios are 0 and all is allowed that no
    rule blocks. Repeated rows are judged and counted each; an empty table gives no rows. Other columns are not read;
    `keep` must not name the result's own columns.
    """
    read = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(url).cast("string").alias("_url"))
    ruled = with_rules(read, "_url", rules).withColumn("_text", model_text(rules)).drop("_url")
    examples = ruled.filter(F.col("rule").isNotNull()).select(
        (F.col("ruled") == ALLOW).alias("accepted"), F.col("_text").alias("text"),
        (F.crc32("_text") % HELD_OUT == 0).alias("held"),
    )
    models = learn(examples.filter(~F.col("held")).select("accepted", "text"), order, support)
    if not all(len(m.contexts) for m in models):
        return ruled.select(
            *[F.col(f"`{c}`") for c in keep], "host", "path", "rule", F.lit(0.0).alias("ratio"),
            F.coalesce("ruled", F.lit(ALLOW)).alias("verdict"),
        )
    tested = scored(examples.filter("held").select("accepted", "text"), models, "text", "ratio")
    bin_of = F.least(F.greatest(F.floor(F.col("ratio") / BIN) + BINS // 2, F.lit(0)), F.lit(BINS - 1))
    seen = tested.groupBy("accepted", bin_of.alias("bin")).count().collect()  # at most two rows per bin
    cut = cut_between(*({r.bin: r["count"] for r in seen if r.accepted == kind} for kind in (True, False)))
    found = scored(ruled, models, "_text", "ratio")
    by_model = F.when(F.col("ratio") >= cut, ALLOW).otherwise(BLOCK)
    return found.select(
        *[F.col(f"`{c}`") for c in keep], "host", "path", "rule", "ratio",
        F.coalesce("ruled", by_model).alias("verdict"),
    )
