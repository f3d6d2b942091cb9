"""Secret scans over an incremental blob ledger.

Every version of every path is addressed by the SHA-256 of its content. The ledger
says which rules, at which version, have seen a blob and what they found. A scan
reads only blobs with a rule version that the ledger lacks, once for all copies,
appends to the ledger and joins the findings back to all paths. DataFrame
functions only."""

import uuid

from pyspark.sql import functions as F

from meterspan.llm.samples import sized
from meterspan.session import written

# Kind, version, pattern, group whose length counts, least length.
# For access and hex, a failing match ends where its run ends, so the least length
# may stand in the pattern; for assign it is checked after the match.
RULES = (
    ("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", 1, r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", 1, r"[0-9a-f]{24,}", 0, 24),
    ("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    ("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
)
BASE = ("assign", "access", "hex")
MASK = "[REDACTED]"
_SPAN = "array<struct<start:bigint,place:int,kind:string,end:bigint>>"
#: In the ledger a span has the version of its rule; its place follows the rules of a scan.
_KEPT = "array<struct<start:bigint,rule:string,kind:string,end:bigint>>"
_LEDGER = f"blob string, scanned array<string>, spans {_KEPT}"


def _named(rule):
    return f"{rule[0]}@{rule[1]}"


def _spans(body, rule):
    """Spans of one rule in code points: what lies between the matches, and the
    matches, add up to the places."""
    kind, _, pattern, group, least = rule
    name = _named(rule)
    matches = F.regexp_extract_all(body, F.lit(pattern), F.lit(0))
    both = F.zip_with(
        F.transform(F.split(body, pattern, -1), F.length),
        F.zip_with(matches, F.regexp_extract_all(body, F.lit(pattern), F.lit(group)), lambda m, g: F.struct(F.length(m).alias("m"), F.length(g).alias("g"))),
        lambda gap, x: F.struct(gap.alias("gap"), x["m"].alias("m"), x["g"].alias("g")),
    )
    none = F.array().cast(_KEPT)
    start = F.struct(F.lit(0).cast("long").alias("at"), none.alias("out"))

    def add(s, x):
        a = s["at"] + x["gap"]
        span = F.struct(a.alias("start"), F.lit(name).alias("rule"), F.lit(kind).alias("kind"), (a + x["m"]).alias("end"))
        return F.struct((a + F.coalesce(x["m"], F.lit(0))).alias("at"), F.when(x["g"] >= least, F.concat(s["out"], F.array(span))).otherwise(s["out"]).alias("out"))

    return F.when(body.rlike(pattern), F.aggregate(both, start, add, lambda s: s["out"])).otherwise(none)


def read_ledger(spark, path):
    """The ledger's rows; an empty frame where no scan has been recorded."""
    home = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = home.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(home) and len(files.listStatus(home)):
        return spark.read.schema(_LEDGER).parquet(f"{path}/*")
    return spark.createDataFrame([], _LEDGER)


def scan(versions, ledger, rules=RULES):
    """Bring the ledger (a folder) up to date with the texts of ``versions``. Returns
    ``versions`` with ``blob``, and the blobs with findings of ``rules``: blob, spans by
    start and kind. Columns of these names in ``versions`` are replaced. Only findings
    of the rules at the versions given count: what an older version of a rule has found,
    or one that is no longer given, stays in the ledger and comes back with that rule.

    A null text is an empty blob. Copies, over paths and over time, are read once for
    each rule version. A batch that was recorded is not scanned again, so a job that
    lost its driver resumes. Runs jobs: the ledger is written here."""
    spark = versions.sparkSession
    body = F.coalesce(F.col("text"), F.lit(""))
    versions = versions.drop("blob", "spans")
    addressed = versions.select(F.sha2(body.cast("binary"), 256).alias("blob"), body.alias("body"))
    wanted = F.array(*(F.lit(_named(r)) for r in rules))
    known = read_ledger(spark, ledger)
    seen = known.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("scanned"))).alias("seen"))
    todo = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))
    unseen = addressed.groupBy("blob").agg(F.first("body").alias("body")).join(seen, "blob", "left").withColumn("todo", todo).where(F.size("todo") > 0)
    found = [
        F.when(F.array_contains("todo", _named(r)), _spans(F.col("body"), r)).otherwise(F.array().cast(_KEPT)) for r in rules
    ]
    fresh = unseen.select("blob", F.col("todo").alias("scanned"), F.array_sort(F.concat(*found)).alias("spans"))
    fresh.write.parquet(f"{ledger}/scan-{uuid.uuid4().hex}")
    names = F.array(*(F.lit(_named(r)) for r in rules))

    def current(spans):
        placed = F.transform(
            F.filter(spans, lambda s: F.array_contains(names, s["rule"])),
            lambda s: F.struct(s["start"].alias("start"), (F.array_position(names, s["rule"]) - 1).cast("int").alias("place"), s["kind"].alias("kind"), s["end"].alias("end")),
        )
        return F.array_sort(F.array_distinct(placed))

    kept = read_ledger(spark, ledger).where(F.size("spans") > 0).groupBy("blob").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    hits = kept.select("blob", current(F.col("spans")).alias("spans")).where(F.size("spans") > 0)
    hits = written(hits, "secret-hits")
    paths = versions.withColumn("blob", F.sha2(body.cast("binary"), 256))
    return paths, hits


def findings(versions, ledger, rules=RULES):
    """``scan`` joined back to all paths: ``versions`` with ``blob`` and ``spans``."""
    paths, hits = scan(versions, ledger, rules)
    return paths.join(sized(hits, 200_000), "blob", "left").withColumn("spans", F.coalesce("spans", F.array().cast(_SPAN)))


def joined(spans):
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(body, spans):
    """The text with every span masked; spans that touch or overlap share a mask."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def add(s, x):
        kept = F.substring(body, (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int"))
        fresh = F.when((x["start"] > s["at"]) | (s["at"] == 0), F.concat(s["out"], F.array(kept, F.lit(MASK)))).otherwise(s["out"])
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), fresh.alias("out"))

    def close(s):
        return F.concat(F.array_join(s["out"], ""), F.substring(body, (s["at"] + 1).cast("int"), F.length(body)))

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, add, close)).otherwise(body)
