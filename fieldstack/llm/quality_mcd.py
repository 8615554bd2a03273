"""Quality rules: base text statistics, and robust multivariate outliers by language and source.

Base rules: a text with fewer than ``min_words`` words, or with more than ``max_repeat_percent`` % of its
words in repeated 3-word windows, fails.

Method: five statistics of each text are log-transformed and rounded to integers (so sums are exact and
don't depend on the order of rows). For each (language, source) the minimum-covariance-determinant
estimate of centre and covariance is found by concentration steps: keep the ``h`` share of
rows nearest by Mahalanobis distance, re-estimate from them, repeat. Two starts (medians with absolute
deviations; mean with covariance) are concentrated and the one of the smaller determinant is taken. Rows
beyond ``cutoff`` (a chi-square quantile at 5 degrees of freedom) are rejected. Groups under ``min_group`` rows
use the estimate of their language, or of all rows if that is small as well.

Each step is one grouped aggregate of sums over a narrow table of statistics, combined map-side, so a group
with a third of all rows is spread over all tasks; distances are ranked by rounded logarithms, of which
there are a few hundred values. ``floors`` are standard deviations that are always added: a statistic that is
constant in most rows (no symbols, no repeated line) doesn't condemn the first row that differs.

Built-in functions only. Defined results: a null or empty text has no words and fails the base rules; null
languages and sources are groups like others; repeated rows are judged each and all count; an empty
table gives an empty result; extra columns pass through, and those of the added names are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import own, stash

P = 5
CHI2_MEDIAN = 4.3515        # chi-square, 5 degrees of freedom: median
CHI2_CUTOFF = 35.888        # and its 0.999999 quantile: tables and boilerplate stay, symbol junk goes
SCALE = 64                  # integer steps in one unit of a logarithm
FLOORS = (0.5, 0.1, 0.3, 1.0, 1.0)      # clean texts have up to a third of their lines twice, but hardly a symbol
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SPACES = r" \t\n\u000B\u000C\r"


def text_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` without text, plus STATS and n_lines."""
    def count(chars: list[str]) -> str:
        return " + ".join(f"octet_length(qm_t) - octet_length(replace(qm_t, '{c}', ''))" for c in chars)

    staged = (
        docs.withColumn("qm_t", F.expr("coalesce(text, '')"))
        .withColumn("qm_w", F.expr(f"split(btrim(qm_t, '{_SPACES}'), '[\\\\x20\\\\x09-\\\\x0D]+')"))
        .withColumn("n_words", F.expr("if(get(qm_w, 0) = '', 0, array_size(qm_w))"))
        # all 64 bits of the hash of a 3-word window, and its position
        .withColumn("qm_s", F.expr("""
            if(n_words < 4, array(), sort_array(slice(transform(qm_w, (w, i) ->
               named_struct('h', xxhash64(w, get(qm_w, i + 1), get(qm_w, i + 2)), 'i', i)), 1, n_words - 2)))"""))
        .withColumn("qm_p", F.expr("""
            sort_array(transform(filter(qm_s, (x, i) ->
                coalesce(x.h = get(qm_s, i + 1).h, false) or coalesce(x.h = get(qm_s, i - 1).h, false)),
                x -> x.i))"""))
        .withColumn("qm_l", F.expr("split(qm_t, '\\n', -1)"))
        .withColumn("qm_f", F.expr("filter(qm_l, l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')"))
    )
    return staged.withColumns({
        "n_words": F.expr("cast(n_words as bigint)"),
        "word_chars": F.expr(f"cast(length(qm_t) - ({count([' ', r'\t', r'\n', r'\u000B', r'\u000C', r'\r'])}) as bigint)"),
        "n_symbols": F.expr(f"cast({count(list('#*$%&|<>'))} as bigint)"),
        "n_dup_lines": F.expr("cast(array_size(qm_f) - array_size(array_distinct(qm_f)) as bigint)"),
        "n_lines": F.expr("cast(array_size(qm_l) as bigint)"),
        "n_repeat_words": F.expr("""cast(coalesce(aggregate(transform(qm_p, (p, i) ->
            least(3L, coalesce(get(qm_p, i + 1) - p, 3L))), 0L, (a, x) -> a + x), 0L) as bigint)"""),
    }).drop("text", "qm_t", "qm_w", "qm_s", "qm_p", "qm_l", "qm_f")


def _features(stats: DataFrame) -> DataFrame:
    parts = ["n_words", "word_chars / nullif(n_words, 0)", "100 * n_symbols / nullif(word_chars, 0)",
             "100 * n_dup_lines / nullif(n_lines, 0)", "100 * n_repeat_words / nullif(n_words, 0)"]
    return stats.withColumns({f"qm_x{i}": F.expr(f"cast(round({SCALE} * ln(1 + coalesce({e}, 0))) as bigint)")
                              for i, e in enumerate(parts)})


def _with_group(rows: DataFrame, min_group: int) -> DataFrame:
    """A key that says which estimate a row uses."""
    both = rows.groupBy("lang", "source").agg(F.count("*").alias("qm_n"))
    langs = both.groupBy("lang").agg(F.sum("qm_n").alias("qm_m"))
    names = (both.select(F.col("lang").alias("qm_lang"), F.col("source").alias("qm_source"), "qm_n")
             .join(langs, F.col("qm_lang").eqNullSafe(F.col("lang"))).drop("lang"))
    text = "concat('l', coalesce(concat('=', qm_lang), ''))"
    names = names.withColumn("qm_g", F.expr(f"""
        case when qm_n >= {min_group} then concat({text}, char(1), 's', coalesce(concat('=', qm_source), ''))
             when qm_m >= {min_group} then {text} else 'all' end""")).drop("qm_n", "qm_m")
    return rows.join(names, F.col("lang").eqNullSafe(F.col("qm_lang"))
                     & F.col("source").eqNullSafe(F.col("qm_source")), "left").drop("qm_lang", "qm_source")


def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(P) for j in range(i + 1)]


def _moments(rows: DataFrame, keys: list[str]) -> DataFrame:
    sums = [F.count("*").alias("n")] + [F.sum(f"qm_x{i}").alias(f"s{i}") for i in range(P)]
    sums += [F.sum(F.col(f"qm_x{i}") * F.col(f"qm_x{j}")).alias(f"s{i}{j}") for i, j in _pairs()]
    out = rows.groupBy(*keys).agg(*sums)
    return out.select(*keys, "n", *[F.expr(f"s{i} / n").alias(f"m{i}") for i in range(P)], *[
        F.expr(f"s{i}{j} / n - (s{i} / n) * (s{j} / n)").alias(f"c{i}{j}") for i, j in _pairs()])


def _inverse_root(est: DataFrame, keys: list[str]) -> DataFrame:
    """Adds the floors, then r_ij: the inverse of the Cholesky factor, and the log determinant."""
    df = est.withColumns({f"c{i}{i}": F.col(f"c{i}{i}") + (FLOORS[i] * SCALE) ** 2 for i in range(P)})
    for i in range(P):          # row by row: l_ij, then the inverse's row
        for j in range(i):
            inner = " + ".join([f"l{i}{k} * l{j}{k}" for k in range(j)]) or "0D"
            df = df.withColumn(f"l{i}{j}", F.expr(f"(c{i}{j} - ({inner})) / l{j}{j}"))
        inner = " + ".join([f"l{i}{k} * l{i}{k}" for k in range(i)]) or "0D"
        df = df.withColumn(f"l{i}{i}", F.expr(f"sqrt(greatest(c{i}{i} - ({inner}), 1e-6))"))
        for j in range(i):
            inner = " + ".join(f"l{i}{k} * r{k}{j}" for k in range(j, i))
            df = df.withColumn(f"r{i}{j}", F.expr(f"-({inner}) / l{i}{i}"))
        df = df.withColumn(f"r{i}{i}", F.expr(f"1 / l{i}{i}"))
    det = " + ".join(f"ln(l{i}{i})" for i in range(P))
    return df.select(*keys, *[f"m{i}" for i in range(P)], *[f"r{i}{j}" for i, j in _pairs()],
                     F.expr(f"2 * ({det})").alias("logdet"))


def _distance(rows: DataFrame, est: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with qm_d2, the squared Mahalanobis distance to their group's estimate."""
    squares = []
    for i in range(P):
        z = " + ".join(f"r{i}{j} * (qm_x{j} - m{j})" for j in range(i + 1))
        squares.append(f"power({z}, 2)")
    return rows.join(est, keys, "left").withColumn("qm_d2", F.expr(" + ".join(squares)))


_RANK = "cast(round(32 * log2(1 + qm_d2)) as int)"


def mcd_estimates(rows: DataFrame, h: float = 0.75, steps: int = 3) -> DataFrame:
    """(qm_g, centre, inverse root, qm_scale) of every group of ``rows`` (qm_g, qm_x0 ..)."""
    every = rows.select("qm_g", *[f"qm_x{i}" for i in range(P)])
    plain = _moments(every, ["qm_g"]).withColumn("start", F.lit(1))
    # medians and mean absolute deviations from them; the statistics are integers of a bounded range
    # group tables (a row for each language and source) are written before they meet the rows: small ones are then sent to all tasks, larger ones leave hot groups splittable
    medians = stash(every.groupBy("qm_g").agg(*[F.percentile(f"qm_x{i}", 0.5).alias(f"m{i}") for i in range(P)]), "mcd", 1)
    spread = every.join(medians, "qm_g").groupBy("qm_g", *[f"m{i}" for i in range(P)]).agg(
        F.count("*").alias("n"),
        *[F.percentile(F.abs(F.col(f"qm_x{i}") - F.col(f"m{i}")), 0.5).alias(f"d{i}") for i in range(P)])
    robust = spread.select("qm_g", "n", *[f"m{i}" for i in range(P)], *[
        (F.expr(f"power(1.4826 * d{i}, 2)") if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in _pairs()],
        F.lit(2).alias("start"))
    keys = ["qm_g", "start"]
    est = stash(_inverse_root(plain.unionByName(robust), keys), "mcd", 1)
    both = every.withColumn("start", F.explode(F.array(F.lit(1), F.lit(2))))
    for _ in range(steps):
        near = _distance(both, est, keys).withColumn("qm_r", F.expr(_RANK))
        limit = stash(near.groupBy(*keys).agg(F.percentile("qm_r", h).alias("qm_h")), "mcd", 1)
        est = stash(_inverse_root(_moments(near.join(limit, keys).where("qm_r <= qm_h"), keys), keys), "mcd", 1)
    best = est.groupBy("qm_g").agg(F.min_by("start", F.struct("logdet", "start")).alias("start"))
    est = stash(est.join(best, ["qm_g", "start"]).drop("start", "logdet"), "mcd", 1)
    # consistency: the median distance of the group's rows is that of a normal sample, or less
    scale = (_distance(every, est, ["qm_g"]).groupBy("qm_g")
             .agg(F.expr(f"greatest(1D, (power(2D, percentile({_RANK}, 0.5) / 32) - 1) / {CHI2_MEDIAN})").alias("qm_scale")))
    return stash(est.join(scale, "qm_g"), "mcd", 1)


def quality_rules(docs: DataFrame, min_words: int = 50, max_repeat_percent: int = 50, h: float = 0.75,
                  steps: int = 3, min_group: int = 50, cutoff: float = CHI2_CUTOFF) -> DataFrame:
    """``docs`` without text, plus STATS, n_lines, base_failed, distance2 (null where a base rule failed) and kept."""
    docs = own(docs, "qm_", *STATS, "n_lines", "base_failed", "distance2", "kept")
    failed = F.expr(f"n_words < {min_words} or 100 * n_repeat_words > {max_repeat_percent} * n_words")
    rows = stash(_with_group(_features(text_statistics(docs).withColumn("base_failed", failed)), min_group), "quality")
    est = mcd_estimates(rows.where("not base_failed"), h, steps)
    judged = _distance(rows, est, ["qm_g"]).withColumn(
        "distance2", F.expr("if(base_failed, null, qm_d2 / qm_scale)"))
    return judged.withColumn("kept", F.expr(f"not base_failed and coalesce(distance2 <= {cutoff}, true)")).select(
        *[c for c in docs.columns if c != "text"], *STATS, "n_lines", "base_failed", "distance2", "kept")
