"""Quality rules as a bitmask ledger (DataFrame functions only).

Every rule is evaluated once per document. The ledger keeps the measurements
and one failure bit per rule; a *policy* is a versioned set of bits that
reject. Verdicts of any policy, and the effect of leaving a rule out, are then
bitwise operations on the ledger: the text is never read again.

Defined cases: a NULL or blank text has no words, all its measurements are 0
and it fails ``few_words``. Repeated rows are judged one by one. Input columns
are never touched: the ledger columns are prefixed ``qr_`` when they would
clash with a column of the input.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import GAP, let

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_upper")
SHINGLE = 8


@dataclass(frozen=True)
class Rule:
    """A named predicate over the measurements; true = the document fails it."""
    bit: int
    name: str
    sql: str


#: Bits are never reused: a changed rule gets a new bit, so old ledgers keep their meaning.
RULES = (
    Rule(0, "few_words", "n_words < 20"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "duplicate_lines", "n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines"),
    Rule(4, "mean_word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule(5, "upper_case", "2 * n_upper > word_chars"),
)

#: Policies by version: the rules that reject a document.
POLICIES = {
    "base-1": ("few_words", "repeated_windows"),
    "strict-1": tuple(r.name for r in RULES),
}


def policy_mask(names) -> int:
    by_name = {r.name: r for r in RULES}
    return sum(1 << by_name[n].bit for n in names)


def repeated_words(words: Column) -> Column:
    """Number of words inside 8-word windows whose words occur at two or more places.

    Window identities are 64-bit hashes of the eight words' hashes. Equal
    windows become neighbours by sorting (hash, position), so a document of n
    words costs n log n; documents without a repeat skip that sort.
    """
    def positions(windows: Column) -> Column:
        pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeats(p: Column) -> Column:
            last = F.size(p) - 1
            hit = F.transform(p, lambda x, k: F.when(
                ((k > 0) & (F.get(p, k - 1)["h"] == x["h"]))
                | ((k < last) & (F.get(p, k + 1)["h"] == x["h"])), x["i"]))
            return F.array_sort(F.filter(hit, lambda x: x.isNotNull()))
        return let(pairs, repeats)

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda x, k: F.least(
            F.lit(SHINGLE), F.coalesce(F.get(at, k + 1) - x, F.lit(SHINGLE))))
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def count(windows: Column) -> Column:
        unique = F.size(F.array_distinct(windows)) == F.size(windows)
        return F.when(unique, F.lit(0).cast("bigint")).otherwise(let(positions(windows), covered))

    def windows(hashes: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(hashes) - (SHINGLE - 1)),
                           lambda i: F.xxhash64(F.slice(hashes, i, SHINGLE)))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) <= SHINGLE, F.lit(0).cast("bigint")).otherwise(
        let(hashes, lambda h: let(windows(h), count)))


def _free(columns, name: str) -> str:
    return name if name not in columns else _free(columns, f"qr_{name}")


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with their measurements and ``failed_bits`` (one bit per rule)."""
    names = {m: _free(docs.columns, m) for m in (*MEASURES, "failed_bits")}
    t, w, ln = (_free(docs.columns, x) for x in ("_qr_text", "_qr_words", "_qr_lines"))
    words = F.filter(F.split(F.col(t), GAP), lambda x: x != "")
    lines = F.filter(F.split(F.col(t), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.withColumn(t, F.coalesce(F.col(text).cast("string"), F.lit("")))
    out = out.withColumns({w: words, ln: lines})
    dup = F.size(ln) - F.size(F.array_distinct(ln))
    measures = {
        "n_words": F.size(w).cast("bigint"),
        "word_chars": F.length(F.regexp_replace(F.col(t), GAP, "")).cast("bigint"),
        "n_symbols": F.length(F.regexp_replace(F.col(t), r"[^#*$%&|<>]+", "")).cast("bigint"),
        "n_dup_lines": dup.cast("bigint"),
        "n_repeat_words": repeated_words(F.col(w)),
        "n_lines": F.size(ln).cast("bigint"),
        "n_upper": F.length(F.regexp_replace(F.col(t), r"\P{Lu}+", "")).cast("bigint"),
    }
    out = out.withColumns({names[k]: c for k, c in measures.items()}).drop(t, w, ln)
    return out.withColumn(names["failed_bits"], bits(names))


def bits(names: dict[str, str] | None = None) -> Column:
    """The failure bits from the measurement columns."""
    def rule(r: Rule) -> Column:
        sql = r.sql
        for m, c in (names or {}).items():
            if m != c:
                sql = sql.replace(m, f"`{c}`")
        return F.when(F.expr(sql), F.lit(1 << r.bit)).otherwise(F.lit(0))
    total = rule(RULES[0])
    for r in RULES[1:]:
        total = total.bitwiseOR(rule(r))
    return total


def kept(policy: str, failed_bits: str = "failed_bits") -> Column:
    """Verdict of a policy version on a ledger."""
    return F.col(failed_bits).bitwiseAND(F.lit(policy_mask(POLICIES[policy]))) == 0


def ablation(led: DataFrame, policy: str, failed_bits: str = "failed_bits") -> DataFrame:
    """Per rule of a policy: documents that fail it, and documents that only it rejects
    (those a policy without the rule would keep). One aggregation by failure
    mask, whose groups are bounded by the number of rule combinations."""
    mask = policy_mask(POLICIES[policy])
    modes = (led.groupBy(F.col(failed_bits).bitwiseAND(F.lit(mask)).alias("m"))
             .agg(F.count("*").alias("n")))
    chosen = [r for r in RULES if r.name in POLICIES[policy]]
    each = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).alias("bit"))
                               for r in chosen])).alias("r")
    rows = modes.select("m", "n", each)
    return rows.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(F.col("m").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("m") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("only_this_rule"),
        F.sum(F.when(F.col("m") == 0, F.col("n")).otherwise(0)).alias("kept_by_policy"))


def filter_documents(docs: DataFrame, policy: str = "strict-1") -> DataFrame:
    """The documents a policy keeps, with the input's columns."""
    bit = _free(docs.columns, "failed_bits")
    return ledger(docs).where(kept(policy, bit)).select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark, docs: DataFrame) -> DataFrame:
    led = ledger(docs.select("doc_id", "text"))
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", (~kept("base-1")).alias("base_failed"),
                      kept("strict-1").alias("kept"),
                      F.col("failed_bits").cast("bigint").alias("failed_bits"))


SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
a AS (SELECT doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM t),
win AS (SELECT doc_id, i, array_to_string(ws[i:i+7], ' ') AS s
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM a WHERE len(ws) >= 8)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS k FROM win) WHERE k > 1),
cov AS (SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n
        FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM rep) GROUP BY doc_id),
m AS (SELECT a.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(ls) AS BIGINT) AS n_lines,
        CAST(length(regexp_replace(text, '\\P{Lu}+', '', 'g')) AS BIGINT) AS n_upper
      FROM a LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, CAST((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT
        + 4 * (10 * n_symbols > n_words)::INT + 8 * (n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines)::INT
        + 16 * (word_chars < 2 * n_words OR word_chars > 15 * n_words)::INT
        + 32 * (2 * n_upper > word_chars)::INT AS BIGINT) AS failed_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed, failed_bits = 0 AS kept, failed_bits FROM b
"""
