"""Secret scans weighed by how many owners share a candidate.

Candidates are the matches of a few patterns. Their hashes are counted over
the whole corpus by distinct owner and distinct repository: a value that many
owners hold is a widely copied example, one that few hold and that looks random
is taken for a live credential. All steps are built-in functions; the counts
are combined before each shuffle, and a value that a third of all rows hold is
one row per owner and repository by then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.llm.common import fresh, stored

# A private key runs to its END line; without one, to the end of its lines of base64. Lines may be quoted or escaped.
_GAP = r"""(?:\\[nr]|[\s"'`,>#|*+])+"""
_LINE = _GAP + "[A-Za-z0-9+/=]{16,}"
PEM = (
    r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"
    r"(?:[^-]*(?:-[^-]+){0,16}-----END [A-Z ]{0,20}PRIVATE KEY-----"
    rf"|(?:{_GAP}(?:Proc-Type|DEK-Info):\x20*[A-Za-z0-9,-]+){{0,2}}"
    rf"(?:{_LINE})*(?:{_GAP}[A-Za-z0-9+/]{{0,15}}={{1,2}})?)"
)
# The patterns, in the order in which spans of one start are listed. The base kinds come first.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = {
    "assign": ASSIGN,
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
    "pem": PEM,
    "vendor": r"(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|[sr]k_live_[A-Za-z0-9]{16,})",
    "jwt": r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
}
#: The same for Java: it recurses once per repeated line unless the repetition is possessive.
JAVA = PATTERNS | {"pem": PEM.replace(f"(?:{_LINE})*", f"(?:{_LINE})*+")}
BASE = ("assign", "access", "hex")
#: Shortest value of an assignment.
VALUE = 6
#: A value that so many owners hold is a widely copied example.
EXAMPLE_OWNERS = 3
#: Fewer different characters than this do not look like a credential.
DISTINCT_CHARS = 6
MASK = "[SECRET]"

_SPAN = "struct<start:bigint,ord:int,end:bigint,kind:string,hash:string,varied:boolean>"


def _matches(text: Column, kind: str, ordinal: int) -> Column:
    """The kind's spans of a text: gaps and matches alternate, and their lengths add up to positions."""
    pattern = JAVA[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.zip_with(
        F.split(text, pattern, -1), found, lambda gap, hit: F.struct(F.char_length(gap).alias("gap"), hit.alias("hit"))
    )
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{_SPAN}>").alias("spans"))

    def step(acc: Column, piece: Column) -> Column:
        start = acc["at"] + piece["gap"]
        end = start + F.char_length(piece["hit"])
        value = F.regexp_extract(piece["hit"], pattern, 2) if kind == "assign" else piece["hit"]
        span = F.struct(
            start.alias("start"),
            F.lit(ordinal).alias("ord"),
            end.alias("end"),
            F.lit(kind).alias("kind"),
            F.sha2(value, 256).alias("hash"),
            (F.size(F.array_distinct(F.split(value, ""))) >= DISTINCT_CHARS).alias("varied"),
        )
        counts = piece["hit"].isNotNull()
        if kind == "assign":
            counts = counts & (F.char_length(value) >= VALUE)
        spans = F.when(counts, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct(F.coalesce(end, start).alias("at"), spans.alias("spans")).cast(
            f"struct<at:bigint,spans:array<{_SPAN}>>"
        )

    spans = F.aggregate(pieces, zero, step, lambda acc: acc["spans"])
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(f"array<{_SPAN}>"))


def find_spans(text: Column) -> Column:
    """All candidate spans of a text by start, then kind as listed; NULL counts as empty."""
    text = F.coalesce(text, F.lit(""))
    return F.array_sort(F.flatten(F.array(*[_matches(text, kind, i) for i, kind in enumerate(PATTERNS)])))


def ownership(candidates: DataFrame) -> DataFrame:
    """``(hash, owner, repo)`` rows -> ``(hash, n_owners, n_repos, n_uses)``.

    A repository belongs to its owner. A NULL owner or repository adds to the
    uses only.
    """
    repos = candidates.groupBy("hash", "owner", "repo").agg(F.count("*").alias("uses"))
    owners = repos.groupBy("hash", "owner").agg(F.count("repo").alias("repos"), F.sum("uses").alias("uses"))
    return owners.groupBy("hash").agg(
        F.count("owner").alias("n_owners"),
        F.sum(F.when(F.col("owner").isNotNull(), F.col("repos")).otherwise(0)).alias("n_repos"),
        F.sum("uses").alias("n_uses"),
    )


def _judged(scanned: DataFrame, owners: int) -> DataFrame:
    """``scanned(uid, owner, repo, spans)`` -> ``(uid, judged)``, spans with ``live``, of rows that have spans."""
    spans = scanned.select("uid", "owner", "repo", F.inline("spans"))
    shared = ownership(spans.select("hash", "owner", "repo"))
    live = F.col("varied") & (F.col("n_owners") < owners)
    span = F.struct("start", "ord", "end", "kind", live.alias("live"))
    return spans.join(shared, "hash").groupBy("uid").agg(F.sort_array(F.collect_list(span)).alias("judged"))


def _listed(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def scan_secrets(docs: DataFrame, owner: Column, repo: Column, owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per input row with its spans and how they are judged.

    Columns: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live,
    n_example, live_spans. A NULL text is empty; repeated rows and NULL ids
    are rows like others; an empty table gives an empty result. Spans that are
    neither live nor held by ``owners`` owners are counted in neither.
    """
    scanned = stored(
        docs.select(
            F.monotonically_increasing_id().alias("uid"),
            F.col("doc_id").cast("long").alias("doc_id"),
            owner.alias("owner"),
            repo.alias("repo"),
            find_spans(F.col("text")).alias("spans"),
        ),
        "spans",
    )
    spans = F.col("spans")
    judged = F.coalesce("judged", F.array().cast("array<struct<start:bigint,ord:int,end:bigint,kind:string,live:boolean>>"))
    shared = ownership(scanned.select("owner", "repo", F.inline("spans")).select("hash", "owner", "repo"))
    example = scanned.select("uid", F.inline("spans")).join(shared.where(F.col("n_owners") >= owners), "hash")
    examples = example.groupBy("uid").agg(F.count("*").alias("n_example"))
    out = scanned.join(_judged(scanned, owners), "uid", "left").join(examples, "uid", "left")
    base = F.filter(spans, lambda s: s["ord"] < len(BASE))
    return out.select(
        "doc_id",
        *[_count(spans, k).alias(f"n_{k}") for k in BASE],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(spans).alias("spans"),
        F.size(F.filter(judged, lambda s: s["live"])).cast("long").alias("n_live"),
        F.coalesce("n_example", F.lit(0).cast("long")).alias("n_example"),
        _listed(F.filter(judged, lambda s: s["live"])).alias("live_spans"),
    )


def _masked(text: Column, spans: Column) -> Column:
    """The text with each of the ascending spans, overlaps merged, replaced by ``MASK``."""
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        out = F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, F.lit(MASK))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    def end(acc: Column) -> Column:
        return F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.lit(2**31 - 1)))

    return F.aggregate(spans, zero, step, end)


def mask_secrets(docs: DataFrame, owner: Column, repo: Column, owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """``docs`` with its live-looking credentials masked; widely copied examples stay.

    Keeps every row and column; ``n_chars``, where there is such a column and
    it is not NULL, follows the masked text. Rows without a candidate do not
    move.
    """
    some = F.coalesce(F.col("text").rlike("|".join(f"(?:{p})" for p in JAVA.values())), F.lit(False))
    uid, spans = fresh(docs, "uid"), fresh(docs, "spans")
    hits = stored(
        docs.where(some)
        .withColumn(uid, F.monotonically_increasing_id())
        .withColumn(spans, F.struct(owner.alias("owner"), repo.alias("repo"), find_spans(F.col("text")).alias("spans"))),
        "hits",
    )
    judged = _judged(hits.select(F.col(uid).alias("uid"), f"{spans}.*"), owners)
    live = judged.select(F.col("uid").alias(uid), F.filter("judged", lambda s: s["live"]).alias(fresh(docs, "judged")))
    live = live.where(F.size(live[live.columns[1]]) > 0)
    masked = hits.join(live, uid, "left")
    text = F.when(F.col(live.columns[1]).isNull(), F.col("text")).otherwise(
        _masked(F.col("text"), F.col(live.columns[1]))
    )
    masked = masked.withColumn("text", text)
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        moved = F.col("n_chars").isNotNull() & F.col(live.columns[1]).isNotNull()
        masked = masked.withColumn("n_chars", F.when(moved, length).otherwise(F.col("n_chars")))
    masked = masked.select(*docs.columns)
    return docs.where(~some).union(masked)
