"""Quality rules under weak supervision, in DataFrame functions only.

Each rule votes good, bad or abstains. Expectation-maximisation over the counts of
vote patterns estimates, for good texts and for each kind of junk, how often each rule that votes calls them
bad, and the posterior probability of good quality decides instead of an all-must-pass filter.

The texts are read once; words, windows and lines are compared inside the row, so
nothing of a text is shuffled, and a very long text costs memory in proportion to
its own words. Patterns are at most 3 ** rules, whatever the size of the corpus:
their counts are one row, the estimate is one expression over it, and the table of
posteriors may be broadcast.

Defined cases: a NULL or empty text has no words, fails the base rules and is not
kept; rows that repeat an id are judged one by one; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import stored, words

# The window of repeats, the symbols, the base rules.
WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
BAD, GOOD, ABSTAIN = 0, 1, 2
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_shouts")


def repeated_words(word_list: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window of ``window`` words found twice or more in the list.

    Windows are compared by 64-bit hashes. Only a list with a repeated window is
    sorted: equal hashes are neighbours then, and the covered words are the union
    of the spans that begin at their places.
    """

    def spans(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
            return F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1))

        places = F.sort_array(F.transform(_let(ordered, twice), lambda x: x["i"]))
        start = F.struct(F.lit(-window).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(
            places,
            start,
            lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(window), p - a["last"])).alias("n")),
            lambda a: a["n"],
        )

    def of(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), spans(hashes)).otherwise(0)

    def windows(one: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(one) - window + 1)
        return F.transform(starts, lambda i: F.xxhash64(F.slice(one, i, window)))

    one = F.transform(word_list, lambda w: F.xxhash64(w))
    return F.when(F.size(word_list) > window, _let(one, lambda o: _let(windows(o), of))).otherwise(0)


def _let(value: Column, body) -> Column:
    """``body(value)``, with the value computed once however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and STATS of each text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select("doc_id", text.alias("text"), words(F.col("text")).alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    line_counts = _let(lines, lambda x: F.struct(F.size(x).alias("all"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
    seen = split.select(
        "doc_id",
        F.size("words").alias("n_words"),
        F.length(F.array_join("words", "")).alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).alias("n_symbols"),
        line_counts.alias("lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        (F.length("text") - F.length(F.replace("text", F.lit("!"), F.lit("")))).alias("n_shouts"),
    )
    seen = seen.withColumn("n_dup_lines", F.col("lines.dup")).withColumn("n_lines", F.col("lines.all"))
    return seen.select("doc_id", *[F.col(c).cast("long").alias(c) for c in STATS])


def _vote(bad: Column, good: Column | None = None) -> Column:
    vote = F.when(bad, BAD)
    return (vote if good is None else vote.when(good, GOOD)).otherwise(ABSTAIN)


def default_rules() -> dict[str, Column]:
    """Votes over STATS. Every rule can speak for a text as well as against it, and abstains in between,
    so the share of bad votes among its votes tells how it does in either class. Heavy cases
    have a rule of their own beside the ordinary one: what is plainly junk gets two bad votes."""
    n, chars = F.col("n_words"), F.col("word_chars")
    symbols, shouts, again = F.col("n_symbols"), F.col("n_shouts"), F.col("n_repeat_words")
    return {
        "length": _vote(n < 30, n >= 80),
        "word_length": _vote((chars < 3 * n) | (chars > 12 * n), (chars >= 4 * n) & (chars <= 9 * n)),
        "symbols": _vote(10 * symbols > n, 50 * symbols <= n),
        "symbol_share": _vote(6 * symbols > chars, 40 * symbols <= chars),
        "lines": _vote(10 * F.col("n_dup_lines") > 3 * F.col("n_lines"), F.col("n_dup_lines") == 0),
        "repeats": _vote(100 * again > 15 * n, 100 * again <= 2 * n),
        "mostly_repeats": _vote(100 * again > 25 * n, 100 * again <= 10 * n),
        "shouts": _vote(20 * shouts > n, 100 * shouts <= n),
    }


# Rules that look at the same side of a text: what several of them call bad is one kind of junk.
FAMILIES = {
    "length": "words", "word_length": "words",
    "symbols": "signs", "symbol_share": "signs", "shouts": "signs",
    "lines": "repeats", "repeats": "repeats", "mostly_repeats": "repeats",
}

# Priors, in votes and documents, whatever the size of the corpus: a good text gets this many bad
# and good votes from a rule, junk those; and so many documents are good, and of each kind of junk.
PRIOR_GOOD_VOTES, PRIOR_JUNK_VOTES = (0.1, 1.9), (1.0, 1.0)
PRIOR_GOOD_DOCS, PRIOR_JUNK_DOCS = 1.7, 0.3
# Probability of a good text with no, one, two or more bad votes from a family, before anything is estimated.
START = (0.99, 0.9, 0.1)
# Numeric limits of a share, so that no logarithm is infinite.
TINY = 1e-6


def posteriors(patterns: DataFrame, families: list[str], iterations: int = 30) -> DataFrame:
    """(pattern, posterior) from (pattern, n): a pattern holds the votes of all rules in base 3, and
    ``families`` names the family of each rule.

    The classes are good texts and one kind of junk a family. For each class and rule the estimate is the
    share of bad votes among the votes the rule cast; an abstention says nothing. What the classes
    mean comes from the start alone (START): two rules of a family that agree make a text a likely case
    of its junk, one alone hardly. A rule that fires alone in many texts is found to be inaccurate,
    unless it also fires where others of its family agree. The posterior is that of the good class.
    The patterns are sorted first, so sums do not depend on their order.
    """
    m, kinds = len(families), sorted(set(families))
    votes = F.array(*[F.floor(F.col("pattern") / 3**j).cast("int") % 3 for j in range(m)])
    row = patterns.groupBy().agg(
        F.sort_array(F.collect_list(F.struct("pattern", votes.alias("v"), F.col("n").cast("double").alias("n")))).alias("a")
    )
    rules_of = [", ".join(str(j) for j in range(m) if families[j] == kind) for kind in kinds]
    counts = ", ".join(f"size(filter(array({js}), j -> element_at(p.v, j + 1) = {BAD}))" for js in rules_of)
    good = f"element_at(array({', '.join(f'{x}D' for x in START)}), cast(least(array_max(c), {len(START) - 1}) as int) + 1)"
    total = "aggregate(c, 0, (s, x) -> s + x)"
    share = f"if({total} = 0, 1D / {len(kinds)}, cast(x as double) / {total})"
    start = f"transform(a, p -> element_at(transform(array(array({counts})), c -> concat(array({good}), transform(c, x -> (1D - {good}) * {share}))), 1))"

    # One round: logarithms of each class's share of documents and of each rule's votes in it, then each pattern's classes.
    def weighed(k: int, test: str = "true") -> str:
        return f"aggregate(zip_with(a, post, (p, q) -> if({test}, p.n * q[{k}], 0D)), 0D, (s, x) -> s + x)"

    classes = []
    for k in range(len(kinds) + 1):
        bad, right = PRIOR_JUNK_VOTES if k else PRIOR_GOOD_VOTES
        cast = weighed(k, f"p.v[j] <> {ABSTAIN}")
        rate = f"least({1 - TINY}D, greatest({TINY}D, ({weighed(k, f'p.v[j] = {BAD}')} + {bad}D) / ({cast} + {bad + right}D)))"
        mass = f"ln({weighed(k)} + {PRIOR_JUNK_DOCS if k else PRIOR_GOOD_DOCS}D)"
        classes.append(f"named_struct('mass', {mass}, 'rates', transform(sequence(0, {m - 1}), j -> {rate}))")
    said = f"CASE p.v[j] WHEN {ABSTAIN} THEN 0D WHEN {BAD} THEN ln(c.rates[j]) ELSE ln(1D - c.rates[j]) END"
    score = f"transform(e, c -> aggregate(sequence(0, {m - 1}), c.mass, (s, j) -> s + {said}))"
    weights = "transform(l, x -> exp(x - array_max(l)))"
    normed = "transform(w, x -> x / aggregate(w, 0D, (s, y) -> s + y))"
    step = (
        f"element_at(transform(array(array({', '.join(classes)})), e -> transform(a, p -> element_at(transform(array({score}), "
        f"l -> element_at(transform(array({weights}), w -> {normed}), 1)), 1))), 1)"
    )
    done = row.withColumn("post", F.expr(f"aggregate(sequence(1, {iterations}), {start}, (post, t) -> {step})"))
    return done.select(F.inline(F.expr("zip_with(a, post, (p, q) -> named_struct('pattern', p.pattern, 'posterior', q[0]))")))


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < 20) | (100 * F.col("n_repeat_words") > 30 * n)


def judged(
    spark: SparkSession,
    docs: DataFrame,
    rules: dict[str, Column] | None = None,
    families: dict[str, str] = FAMILIES,
    threshold: float = 0.5,
) -> DataFrame:
    """doc_id, STATS, pattern, posterior, base_failed and kept for each document. A rule without a family
    has its own."""
    rules = rules or default_rules()
    pattern = sum((F.lit(3**j) * vote for j, vote in enumerate(rules.values())), F.lit(0)).cast("int")
    voted = stored(spark, measured(docs).withColumn("pattern", pattern), "votes")
    counted = voted.groupBy("pattern").agg(F.count("*").alias("n"))
    known = posteriors(counted, [families.get(name, name) for name in rules])  # at most 3 ** rules rows
    return (
        voted.join(F.broadcast(known), "pattern", "left")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
    )


def op1(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return judged(spark, docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "pattern", "posterior"
    )
