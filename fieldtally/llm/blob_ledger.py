"""Operator 4: secret scans over content-addressed versions with a ledger.

Every version of a file is addressed by the SHA-256 of its content (its blob). A
ledger says which blob was scanned under which rule version, so a scan works only
on pairs that the ledger lacks, once per distinct blob; its findings are joined
back to every path that holds the blob. Built-in functions only.

Nulls and empty texts are one blob without findings; repeated rows each get their
findings back; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.llm.basics import cut, table
from fieldtally.llm.spans import digest, find_spans, label


@dataclass(frozen=True)
class Rule:
    """`pattern` finds matches, `keep` (a pattern too) says which of them count."""

    kind: str
    pattern: str
    keep: str
    hint: str
    version: int = 1
    #: the same pattern for engines without look-behind
    sql: str | None = None


BASE_RULES = (
    Rule(
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
        r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12,}$""",
        r"(?i)password|passwd|secret|token|api_?key",
    ),
    Rule("access", "AKIA[A-Z0-9]+", "^.{18,}$", "AKIA"),
    # a run of 16 or more is what a run of any length filtered by length leaves
    Rule("hex", "(?<![0-9a-f])[0-9a-f]{16,}", "", "[0-9a-f]{16}", sql="[0-9a-f]{16,}"),
)
EXTRA_RULES = (
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", "", "PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", "", "eyJ"),
)
RULES = BASE_RULES + EXTRA_RULES
FINDING = "array<struct<kind:string,start:int,end:int>>"


def _findings(text: Column, rule: Rule) -> Column:
    found = find_spans(text, rule.pattern, text.rlike(rule.hint))
    kept = F.filter(found, lambda s: s["value"].rlike(rule.keep)) if rule.keep else found
    return F.transform(
        kept, lambda s: F.struct(F.lit(rule.kind).alias("kind"), s["start"], s["end"])
    )


def scan(
    versions: DataFrame, rules: Sequence[Rule] = RULES, ledger: DataFrame | None = None
) -> DataFrame:
    """The ledger with what `versions` adds: (blob, rule, version, findings).

    `versions` needs `text`. Pairs of blob and rule version in `ledger` are not
    scanned again; a rule with a new version is.
    """
    texts = versions.select(F.coalesce("text", F.lit("")).alias("text"))
    blobs = texts.withColumn("blob", F.sha2("text", 256)).dropDuplicates(["blob"])
    names = [F.concat_ws("@", F.lit(r.kind), F.lit(str(r.version))) for r in rules]
    if ledger is None:
        todo = blobs.withColumn("done", F.array().cast("array<string>"))
    else:
        wanted = F.concat_ws("@", "rule", F.col("version").cast("string")).isin(
            [f"{r.kind}@{r.version}" for r in rules]
        )
        done = ledger.where(wanted).groupBy("blob").agg(
            F.collect_set(F.concat_ws("@", "rule", F.col("version").cast("string"))).alias("done")
        )
        todo = (
            blobs.join(done, "blob", "left")
            .withColumn("done", F.coalesce("done", F.array().cast("array<string>")))
            .where(F.size("done") < len(rules))
        )
    none = F.lit(None).cast(FINDING)
    pairs = F.array(
        *(
            F.struct(
                F.lit(rule.kind).alias("rule"),
                F.lit(rule.version).alias("version"),
                F.when(F.array_contains("done", name), none)
                .otherwise(_findings(F.col("text"), rule))
                .alias("findings"),
            )
            for rule, name in zip(rules, names, strict=True)
        )
    )
    new = todo.select("blob", F.filter(pairs, lambda p: p["findings"].isNotNull()).alias("pairs"))
    rows = cut(new).select("blob", F.explode("pairs").alias("p")).select("blob", "p.*")
    return rows if ledger is None else ledger.select(rows.columns).unionByName(rows)


def join_back(
    versions: DataFrame, ledger: DataFrame, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """`versions` with `findings`: those of its blob under the current rules, in order."""
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    current = F.lit(False)
    for rule in rules:
        current = current | ((F.col("rule") == rule.kind) & (F.col("version") == rule.version))
    found = (
        ledger.where(current & (F.size("findings") > 0))
        .groupBy("blob")
        .agg(F.flatten(F.collect_list("findings")).alias("findings"))
    )
    order = F.transform(
        "findings",
        lambda x: F.struct(
            x["start"], F.array_position(kinds, x["kind"]).alias("rank"), x["end"], x["kind"]
        ),
    )
    found = cut(found.select("blob", F.array_sort(order).alias("findings")))
    blob = F.sha2(F.coalesce("text", F.lit("")), 256)
    return versions.withColumn("blob", blob).join(found, "blob", "left")


def op4_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document; each distinct text is scanned once.

    The documents come as two snapshots: the ledger of the first, half of the texts by
    their checksum, is stored, and the scan of all documents reads only what it lacks.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    first = docs.where(F.crc32(F.coalesce("text", F.lit("")).cast("binary")) % 2 == 0)
    ledger = scan(docs, ledger=scan(first))
    found = join_back(docs, ledger).select(
        "doc_id",
        F.coalesce(
            "findings", F.array().cast("array<struct<start:int,rank:bigint,end:int,kind:string>>")
        ).alias("f"),
    )

    def labels(kinds: Sequence[str]) -> Column:
        return F.transform(
            F.filter("f", lambda x: x["kind"].isin(list(kinds))),
            lambda x: F.concat_ws(
                ":", x["kind"], x["start"].cast("string"), x["end"].cast("string")
            ),
        )

    base = [r.kind for r in BASE_RULES]
    return found.select(
        "doc_id",
        *(F.size(labels([k])).cast("long").alias(f"n_{k}") for k in base),
        digest(labels(base)).alias("base_sha256"),
        F.array_join(labels([r.kind for r in RULES]), ",").alias("spans"),
    )


def _duck_spans(rule: Rule) -> str:
    """A list of this rule's spans in DuckDB; its patterns mean the same there."""
    pattern = (rule.sql or rule.pattern).replace("'", "''")
    kept = rule.keep.replace("'", "''")
    keep = f"regexp_matches(m[i], '{kept}')" if kept else "true"
    length = "lambda x: length(x)"
    return f"""list_transform(list_filter(range(1, len(m) + 1), lambda i: {keep}), lambda i: {{
      's': CAST(list_sum(list_transform(g[1:i], {length}))
        + coalesce(list_sum(list_transform(m[1:i-1], {length})), 0) AS BIGINT),
      'n': length(m[i])}}) FROM (SELECT doc_id, rid, string_split_regex(text, '{pattern}') AS g,
      regexp_extract_all(text, '{pattern}') AS m FROM d)"""


def _duck_sql() -> str:
    parts = []
    for rank, rule in enumerate(RULES):
        body = _duck_spans(rule)
        head, tail = body.rsplit(" FROM (SELECT doc_id", 1)
        parts.append(
            f"SELECT rid, {rank} AS rank, '{rule.kind}' AS kind, unnest({head}) AS x FROM (SELECT doc_id{tail}"
        )
    base = ", ".join(
        f"CAST(count(*) FILTER (WHERE kind = '{r.kind}') AS BIGINT) AS n_{r.kind}" for r in BASE_RULES
    )
    mark = "kind || ':' || (x.s) || ':' || (x.s + x.n)"
    order = "ORDER BY x.s, rank"
    return f"""WITH d AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS text FROM documents),
    f AS ({" UNION ALL ".join(parts)})
    SELECT d.doc_id, {base},
      sha256(coalesce(string_agg({mark}, ',' {order}) FILTER (WHERE rank < {len(BASE_RULES)}), '')) AS base_sha256,
      coalesce(string_agg({mark}, ',' {order}), '') AS spans
    FROM d LEFT JOIN f ON d.rid = f.rid GROUP BY d.rid, d.doc_id"""


OP4_SQL = _duck_sql()
