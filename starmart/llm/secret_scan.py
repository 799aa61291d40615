"""Secret scan over a trigram index.

From each rule's regex a Boolean trigram query is derived: literal parts of
the pattern are multiplied out over alternatives and optional characters, and
every trigram of such a string is mandatory for it. Of the corpus, the
trigrams that some rule asks for are indexed (postings: trigram, row). The
queries are answered by intersecting and uniting postings, and the regexes run
only on the texts that answer them. A rule without mandatory trigrams (a bare
run of hexadecimal digits) scans every text.

A match is located without any Python: the text between matches and the
matches themselves are measured, and a running sum per text gives code point
offsets.

Results in odd cases: null or empty text has no spans; rows that repeat doc_id
and text report the same spans each, other rows under one (or a null) doc_id
are kept apart by their text; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from re import _parser  # the pattern's syntax tree, to derive trigrams from

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starmart.llm.common import broadcast_within, persist

#: Rows up to which the candidates are broadcast.
MAX_BROADCAST_ROWS = 500_000
#: Strings one literal part of a pattern may stand for before it is cut short.
MAX_STRINGS = 32


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    value: int = 0      # group whose length counts
    least: int = 1      # code points it must have
    base: bool = False
    scan: str | None = None  # finds exactly the matches whose value is long enough


#: Patterns and lengths of the kinds that are found.
RULES = [
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", r"[0-9a-f]+", 0, 24, True, r"[0-9a-f]{24,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[sr]k_live_[0-9A-Za-z]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
]

Query = list[list[frozenset[str]]]  # all of (any of (all trigrams of a set))


def trigram_query(pattern: str) -> Query:
    """Trigrams, in lower case, that any match of ``pattern`` must contain."""
    query: Query = []

    def close(strings: set[str]) -> None:
        options = [frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings]
        if options and all(options):
            query.append(sorted(options, key=sorted))

    def several(node) -> set[str] | None:
        """All strings a small part stands for, or None."""
        op, arg = str(node[0]), node[1]
        if op == "LITERAL":
            return {chr(arg).lower()}
        if op == "IN":
            out = set()
            for kind, v in arg:
                if str(kind) != "LITERAL":
                    return None
                out.add(chr(v).lower())
            return out
        if op == "SUBPATTERN":
            return joined(arg[-1])
        if op == "BRANCH":
            parts = [joined(p) for p in arg[1]]
            return set().union(*parts) if all(p is not None for p in parts) else None
        if op == "MAX_REPEAT" and arg[1] <= 4:
            one = joined(arg[2])
            if one is None:
                return None
            out, power = set(), {""}
            for k in range(arg[1] + 1):
                out |= power if k >= arg[0] else set()
                power = {a + b for a in power for b in one}
            return out
        return None

    def joined(nodes) -> set[str] | None:
        out = {""}
        for n in nodes:
            s = several(n)
            if s is None or len(out) * len(s) > MAX_STRINGS:
                return None
            out = {a + b for a in out for b in s}
        return out

    def walk(nodes) -> None:
        now = {""}
        for n in nodes:
            s = several(n)
            if s is not None and len(now) * len(s) <= MAX_STRINGS:
                now = {a + b for a in now for b in s}
                continue
            close(now)
            now = s if s is not None and len(s) <= MAX_STRINGS else {""}
            if s is None and str(n[0]) == "SUBPATTERN":
                walk(n[1][-1])
            elif s is None and str(n[0]) == "MAX_REPEAT" and n[1][0] >= 1:
                walk(n[1][2])
        close(now)

    walk(_parser.parse(pattern))
    return query


def _row_id() -> Column:
    return F.xxhash64("doc_id", "text")


def build_index(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Postings (trigram, rid) of the trigrams that the rules' queries name.
    Written, segment by segment, sorted by trigram."""
    grams = sorted({g for r in rules for any_of in trigram_query(r.pattern) for all_of in any_of for g in all_of})
    low = docs.select(_row_id().alias("rid"), F.lower(F.col("text").cast("string")).alias("low"))
    there = low.select("rid", F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams]).alias("there"))
    rows = there.select(F.explode(F.array_compact("there")).alias("trigram"), "rid")
    return persist(rows.sortWithinPartitions("trigram"), "trigrams")


def candidates(index: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """rid and the kinds whose trigram query the row answers."""
    per_row = index.groupBy("rid").agg(F.collect_set("trigram").alias("has"))

    def answers(query: Query) -> Column:
        every = [reduce(Column.__or__, [F.size(F.array_except(F.array(*map(F.lit, sorted(all_of))), "has")) == 0
                                        for all_of in any_of]) for any_of in query]
        return reduce(Column.__and__, every)

    kinds = [F.when(answers(q), F.lit(r.kind)) for r in rules if (q := trigram_query(r.pattern))]
    return per_row.select("rid", F.array_compact(F.array(*kinds)).alias("kinds")).filter("size(kinds) > 0")


def secret_scan(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """doc_id and spans (start, rank, kind, end; sorted) for every row; offsets
    are code points, end exclusive; rank is the rule's place in ``rules``."""
    index = build_index(docs, rules)
    wanted = persist(candidates(index, rules), "candidates")
    text = F.col("text")
    rows = (docs.select("doc_id", _row_id().alias("rid"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
            .join(broadcast_within(wanted, MAX_BROADCAST_ROWS), "rid", "left"))

    def lengths(column: Column) -> Column:
        return F.transform(column, lambda s: F.length(s))

    found = [F.struct(F.lit(None).cast("int").alias("rank"), *[F.lit(None).cast("array<int>").alias(c) for c in "pmv"])]
    for rank, r in enumerate(rules):
        here = F.array_contains("kinds", r.kind) if trigram_query(r.pattern) else F.lit(True)
        pattern = r.scan or r.pattern
        found.append(F.when(here & text.rlike(pattern), F.struct(
            F.lit(rank).alias("rank"), lengths(F.split(text, pattern, -1)).alias("p"),
            lengths(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("m"),
            lengths(F.regexp_extract_all(text, F.lit(pattern), F.lit(r.value))).alias("v"))))
    rows = persist(rows.select("doc_id", "rid", F.inline(F.array_compact(F.array(*found)))), "found")

    # start of a match: all text before it, matched or not
    one = rows.filter("rank IS NOT NULL").dropDuplicates(["rid", "rank"])
    each = one.select("rid", "rank", F.posexplode(F.arrays_zip(F.slice("p", 1, F.size("m")).alias("p"), "m", "v")).alias("i", "x"))
    so_far = Window.partitionBy("rid", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = each.select("rid", "rank", F.col("x.m").alias("m"), F.col("x.v").alias("v"),
                       F.sum(F.col("x.p") + F.col("x.m")).over(so_far).alias("end"))
    table = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.least).alias("least")) for r in rules])
    each = each.withColumn("rule", F.element_at(table, F.col("rank") + 1)).filter("v >= rule.least")
    span = F.struct((F.col("end") - F.col("m")).alias("start"), "rank", F.col("rule.kind").alias("kind"), "end")
    spans = each.groupBy("rid").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    out = rows.filter("rank IS NULL").select("doc_id", "rid").join(spans, "rid", "left")
    none = F.array().cast(spans.schema["spans"].dataType)
    return out.select("doc_id", F.coalesce("spans", none).alias("spans"))


def digest(found: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    base = [r.kind for r in rules if r.base]

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in base],
                        F.sha2(joined(F.filter("spans", lambda s: s.kind.isin(base))), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def op10_secret_scan(spark, sf_dir: str) -> DataFrame:
    return digest(secret_scan(spark.read.parquet(f"{sf_dir}/documents.parquet")))
