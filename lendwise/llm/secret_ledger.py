"""Secret scans over content-addressed versions (native).

An incremental blob ledger: every version of every path is addressed by the
SHA-256 of its content, only (blob, rule version) pairs the ledger has not
seen are scanned, and the findings of a blob are joined back to every path
and version that holds it.  Only DataFrame and SQL expressions are used.

Positions without a UDF: ``split`` gives the text between the matches of a
pattern and ``regexp_extract_all`` the matches themselves, so the start of a
match is a running sum of both lengths (code points).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .shared import broadcast_if_small, fresh_name, materialise

# The three base patterns and their least lengths.  ``group``
# is the part of the match whose length is tested.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"


@dataclass(frozen=True)
class Rule:
    """One kind of secret.  ``version`` is part of the ledger key: raise it
    when the pattern changes and only that rule scans old blobs again.

    ``scan`` is the pattern that is run.  Where the least length can be part
    of the pattern without changing what is matched it is (a maximal run is
    the same run with or without a least length); otherwise ``group`` and
    ``least`` test the matches afterwards.
    """
    kind: str
    scan: str
    group: int = 0
    least: int = 0
    version: int = 1
    base: bool = True

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# Listed order is the order of kinds at equal starts.
RULES = (
    Rule("assign", ASSIGN, group=2, least=8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----", base=False),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", base=False),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", base=False),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", base=False),
)

# What redaction masks: the rules above, with a private key from its BEGIN
# line over the body to its END line or, where a text has no END, over the
# header fields and base64 lines that follow (a line break may be an escaped
# one).  A scan reports the BEGIN line alone, as op9's SQL does.  Possessive
# groups are matched in a loop, so a long body takes no stack.
_BEGIN = r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----"
_TO_END = r"(?:[^-]|-(?!----))*+-{5,}+END [A-Z ]{0,32}PRIVATE KEY-----"
_BREAK = r"""(?:[\s"'+,>#*|]|\\[nrt])"""
_FIELDS = rf"(?:{_BREAK}++(?:Proc-Type|DEK-Info|Comment|Version):[^\n\\]*+)*+"
_LINES = rf"""(?:{_BREAK}*+[A-Za-z0-9/+]{{16,}}+={{0,2}})++(?:{_BREAK}++[A-Za-z0-9/+]{{1,15}}+={{0,2}}(?=[ \t\r]*+(?:\n|$)|["'\\]))?+"""
_KEY = rf"{_BEGIN}(?:{_TO_END}|{_FIELDS}{_LINES})?+"
MASKED_RULES = tuple(Rule(r.kind, _KEY, version=2, base=False) if r.kind == "private_key" else r for r in RULES)


def _matches(rule: Rule) -> Column:
    """Array of (gap before the match, its length, length of the tested
    group), one per match, in order; empty where the pattern is absent."""
    pattern = F.lit(rule.scan)
    zipped = F.arrays_zip(
        F.split(F.col("text"), rule.scan, -1).alias("gap"),
        F.regexp_extract_all("text", pattern, F.lit(0)).alias("hit"),
        F.regexp_extract_all("text", pattern, F.lit(rule.group)).alias("part"))
    found = F.transform(zipped, lambda m: F.struct(
        F.length(m["gap"]).alias("gap"), F.length(m["hit"]).alias("len"),
        F.length(m["part"]).alias("part")))
    todo = F.array_contains("rules", rule.key) & F.col("text").rlike(rule.scan)
    return F.when(todo, F.filter(found, lambda m: m["len"].isNotNull()))


def find_spans(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(digest, kind, start, end) of every finding in ``blobs`` (digest, text,
    rules: the rule keys to run).  Matches are leftmost and do not overlap
    within a kind; those whose tested part is too short are dropped after
    matching.  A blob that comes in several rows counts once: only its first
    row's matches, the same as in the others, enter the running sums."""
    rows = blobs.select("digest", F.array(*[
        F.struct(F.lit(i).alias("rule"), _matches(r).alias("found"))
        for i, r in enumerate(rules)]).alias("per_rule"))
    rows = (rows.select("digest", F.explode("per_rule").alias("r"))
            .where(F.size("r.found") > 0)
            .select("digest", F.col("r.rule").alias("rule"), F.col("r.found").alias("found"))
            .dropDuplicates(["digest", "rule"])
            .select("digest", "rule", F.posexplode("found")))
    running = Window.partitionBy("digest", "rule").orderBy("pos")
    end = F.sum(F.col("col.gap") + F.col("col.len")).over(running)
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    least = F.array(*[F.lit(r.least) for r in rules])
    return (rows.select("digest", "rule", F.col("col.len").alias("len"),
                        F.col("col.part").alias("part"), end.alias("end"))
            .where(F.col("part") >= F.get(least, F.col("rule")))
            .select("digest", "rule", F.get(kinds, F.col("rule")).alias("kind"),
                    (F.col("end") - F.col("len")).alias("start"), "end"))


class Ledger:
    """The (blob, rule version) pairs already scanned and their findings,
    two parquet tables under one shared folder.

    Findings are appended before the pairs that account for them, and both
    are read as sets, so a job that dies in between scans those blobs again
    and changes nothing else.  One job at a time may append: two at once can
    scan the same blob twice, which changes no finding, but a job reads the
    pairs as they were when it began.
    """

    PAIRS = "digest string, rule_key string"
    FOUND = "digest string, rule_key string, kind string, start long, end long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        there = hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop)
        if not there:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def pairs(self) -> DataFrame:
        return self._read("pairs", self.PAIRS)

    def findings(self) -> DataFrame:
        return self._read("findings", self.FOUND).distinct()

    def append(self, findings: DataFrame, pairs: DataFrame) -> None:
        findings.write.mode("append").parquet(f"{self.path}/findings")
        pairs.write.mode("append").parquet(f"{self.path}/pairs")


def _pending(versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...]) -> DataFrame:
    """One row per blob that has rules left to run: its digest, one version
    that holds it, and the rule keys."""
    blobs = versions.groupBy("digest").agg(F.min(F.struct("path", "version")).alias("at"))
    seen = ledger.pairs().groupBy("digest").agg(F.collect_set("rule_key").alias("seen"))
    every = F.array(*[F.lit(r.key) for r in rules])
    return (blobs.join(seen, "digest", "left")
            .select("digest", "at.path", "at.version",
                    F.array_except(every, F.coalesce("seen", F.array().cast("array<string>"))).alias("rules"))
            .where(F.size("rules") > 0))


def scan(versions: DataFrame, ledger: Ledger, path_col: str = "path",
         version_col: str | None = "version", text_col: str = "text",
         rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Bring the ledger up to date with ``versions`` and return, per version
    row, ``path, version, digest, findings``: an array of (kind, start, end)
    ordered by start, then by the order of ``rules``.

    A null text counts as empty; null paths and versions are kept as they
    are; repeated rows come back as often as given; an empty table gives an
    empty result.  Other columns of the input are ignored.  A hot blob (one
    text under many paths) is scanned once; the join back is an equi join
    whose findings side is unique per blob, so its hot key can be split.
    """
    version = F.lit(0) if version_col is None else F.col(version_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    versions = versions.select(F.col(path_col).alias("path"), version.alias("version"),
                               text.alias("text"), F.sha2(text, 256).alias("digest"))
    keyed = versions.select("path", "version", "digest")
    pending = _pending(keyed, ledger, rules)
    todo = pending.select(F.col("path").alias("p"), F.col("version").alias("v"),
                          F.col("digest").alias("d"), "rules").hint("shuffle_hash")
    # Keyed by path and version, not by content: no hot key carries texts.
    at = (versions.path.eqNullSafe(todo.p) & versions.version.eqNullSafe(todo.v)
          & (versions.digest == todo.d))
    blobs = versions.join(todo, at).select("digest", "text", "rules")
    keys = F.array(*[F.lit(r.key) for r in rules])
    spans = find_spans(blobs, rules).select(
        "digest", F.get(keys, F.col("rule")).alias("rule_key"), "kind", "start", "end")
    ledger.append(spans, pending.select("digest", F.explode("rules").alias("rule_key")))

    order = F.array_position(F.array(*[F.lit(r.kind) for r in rules]), F.col("kind"))
    current = F.col("rule_key").isin([r.key for r in rules])
    found = (ledger.findings().where(current).groupBy("digest")
             .agg(F.sort_array(F.collect_list(F.struct("start", order.alias("order"), "end", "kind")))
                  .alias("findings")))
    empty = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    as_given = F.transform("findings", lambda f: F.struct(f["kind"].alias("kind"),
                           f["start"].alias("start"), f["end"].alias("end")))
    return (keyed.join(found, "digest", "left")
            .select("path", "version", "digest", F.coalesce(as_given, empty).alias("findings")))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")


def masked(text: Column, spans: Column, mask: str) -> Column:
    """``text`` with every span replaced by ``mask``; spans come ordered by
    start, and those that overlap or touch become one mask."""
    first = F.struct(F.lit(-1).cast("long").alias("at"), F.lit("").alias("out"))

    def step(a: Column, f: Column) -> Column:
        since = F.greatest(a["at"], F.lit(0))
        kept = F.substr(text, (since + 1).cast("int"), (f["start"] - since).cast("int"))
        out = F.when(f["start"] > a["at"], F.concat(a["out"], kept, F.lit(mask))).otherwise(a["out"])
        return F.struct(F.greatest(a["at"], f["end"]).alias("at"), out.alias("out"))

    return F.aggregate(spans, first, step, lambda a: F.concat(a["out"], F.substr(text, (a["at"] + 1).cast("int"), F.length(text))))


def redact(docs: DataFrame, ledger: Ledger, id_col: str = "doc_id", text_col: str = "text", mask: str = "[SECRET]",
           rules: tuple[Rule, ...] = MASKED_RULES) -> DataFrame:
    """``docs`` with every secret in ``text_col`` replaced by ``mask``, all
    rows and columns kept.  Findings meet the texts by content, so repeated
    ids do no harm; the few blobs with findings are broadcast while they are
    few, and texts are shuffled only beyond that.  A null text stays null."""
    found = scan(docs, ledger, id_col, None, text_col, rules).where(F.size("findings") > 0)
    found = materialise(found.select("digest", "findings").dropDuplicates(["digest"]), "secret_findings")
    digest, spans = fresh_name(docs, "__digest"), fresh_name(docs, "__findings")
    marks = broadcast_if_small(found.select(F.col("digest").alias(digest), F.col("findings").alias(spans)))
    columns = docs.columns
    joined_ = docs.join(marks, F.sha2(docs[text_col].cast("string"), 256) == F.col(digest), "left")
    text = F.when(F.col(spans).isNotNull(), masked(docs[text_col], F.col(spans), mask)).otherwise(docs[text_col])
    return joined_.select(*[text.alias(c) if c == text_col else docs[c] for c in columns])
