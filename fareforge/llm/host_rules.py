"""Quality rules judged per host.

Text statistics of every document are counted inside its row. Failures of each rule are added up per host, the rates of
small hosts are pulled to the common rate by a beta prior fitted to all hosts, and the verdict goes back to the
documents: a doubtful document is dropped where its host fails the same rule often, a plainly bad one everywhere.
"""
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, materialize, words

#: White space as single characters, and the symbols that are counted.
SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, MOST_REPEATED = 50, 50
#: A document fails a soft rule above `soft` and is plainly bad above `hard`; hosts fail it above `HOST_RATE`.
SOFT = {"symbols": (0.25, 0.8), "dup_lines": (0.3, 0.6), "repeats": (0.2, 0.5)}
HOST_RATE = 0.3


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def _repeated_words(w: Column) -> Column:
    """Words in three-word windows that occur twice or more: windows are sorted by hash beside their place, those equal
    to a neighbour are repeated, and sorted places tell how many words they cover."""
    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(
        F.xxhash64(w[i], w[i + 1], w[i + 2]).alias("h"), i.alias("i")))

    def places(s: Column) -> Column:
        last = F.size(s) - 1
        twice = F.filter(s, lambda x, k: ((k > 0) & (x["h"] == F.get(s, k - 1)["h"]))
                         | ((k < last) & (x["h"] == F.get(s, k + 1)["h"])))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        step = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
        return F.aggregate(step, F.lit(0), lambda a, b: a + b)

    found = let(F.sort_array(windows), lambda s: let(places(s), covered))
    return F.when(F.size(w) >= 3, found).otherwise(0)


def text_stats(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words; zeros for null and empty texts."""
    plain = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(plain, "\n"), lambda x: _without(x, SPACE) > 0)
    return let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        _without(plain, SPACE).cast("long").alias("word_chars"),
        (F.length(plain) - _without(plain, SYMBOLS)).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeated_words(w).cast("long").alias("n_repeat_words"),
        let(lines, F.size).cast("long").alias("n_lines")))


def rule_shares() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {"symbols": F.col("n_symbols") / n,
            "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
            "repeats": F.col("n_repeat_words") / n}


def host_rates(stats: DataFrame, host: str) -> DataFrame:
    """One row per host with the shrunk failure rate of every rule.

    The prior's strength is fitted by moments: what the rates of hosts vary beyond chance. One row of sums over hosts
    comes to the driver; the rates themselves stay distributed.
    """
    fails = {r: F.sum(F.col(f"soft_{r}").cast("long")) for r in SOFT}
    hosts = materialize(stats.groupBy(host).agg(F.count(F.lit(1)).alias("docs"), *[e.alias(r) for r, e in fails.items()]),
                        "hosts")
    rate = {r: F.col(r) / F.col("docs") for r in SOFT}
    seen = hosts.agg(F.count(F.lit(1)).alias("n"), *[F.avg(e).alias(f"m_{r}") for r, e in rate.items()],
                     *[F.var_samp(e).alias(f"v_{r}") for r, e in rate.items()]).first()
    shrunk = []
    for r in SOFT:
        mean, var = seen[f"m_{r}"] or 0.0, seen[f"v_{r}"] or 0.0
        strength = min(max(mean * (1 - mean) / var - 1, 1.0), 1e6) if var > 0 else 1e6
        shrunk.append(((F.col(r) + mean * strength) / (F.col("docs") + strength)).alias(f"rate_{r}"))
    return hosts.select(host, *shrunk)


def judge(docs: DataFrame, host: str = "source") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, host rates) per row.

    Null hosts form one host. Null, empty and blank texts have no words and fail the base rule. Rows that repeat an id
    are judged each; other columns are ignored. An empty table gives an empty result.
    """
    counted = docs.select("doc_id", F.col(host).alias("host"), text_stats(F.col("text")).alias("s")).select("doc_id", "host", "s.*")
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    share = rule_shares()
    flagged = materialize(counted.withColumn("base_failed", base).withColumns(
        {f"soft_{r}": share[r] > soft for r, (soft, _) in SOFT.items()}
        | {f"hard_{r}": share[r] > hard for r, (_, hard) in SOFT.items()}), "stats")
    rates = host_rates(flagged, "host").withColumnRenamed("host", "_host")
    bad = F.lit(False)
    for r in SOFT:
        bad = bad | F.col(f"hard_{r}") | (F.col(f"soft_{r}") & (F.col(f"rate_{r}") > HOST_RATE))
    joined = flagged.join(rates, F.col("host").eqNullSafe(F.col("_host")), "left")
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & ~bad).alias("kept"), *[f"rate_{r}" for r in SOFT])
