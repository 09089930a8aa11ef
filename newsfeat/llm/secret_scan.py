"""Secret scans with corpus-wide ownership: a value in many owners' texts is an example, one owner's is live.

Column expressions only. Candidate values are hashed and counted by distinct owners and
repositories over the whole corpus before a verdict is given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsfeat.session import stored

#: Base kinds in their order: (kind, pattern, group of the value, least characters of the value).
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE_KINDS = (
    ("assign", ASSIGN, 2, 6),
    # a run that is too short cannot hold a longer match, so the least length stands in the pattern
    ("access", r"(AKIA[A-Z0-9]{16,})", 1, 20),
    ("hex", r"([0-9a-f]{24,})", 1, 24),
)
#: Kinds that count only when no more than a few owners have the value.
MORE_KINDS = (
    ("pem", r"(-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\n]*)", 1, 30),
    ("jwt", r"(eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})", 1, 28),
    ("login", r"[a-z]{2,9}://[A-Za-z0-9_.-]{1,64}:([^\x20\x09-\x0D:/@]{3,64})@", 1, 3),
    ("hosted", r"((gh[pousr]_|glpat-|xox[abprs]-|sk_live_)[A-Za-z0-9_-]{16,})", 1, 20),
)
KINDS = (*BASE_KINDS, *MORE_KINDS)
BASE = len(BASE_KINDS)

PEM_NAME = "[A-Z0-9\\x20]*PRIVATE KEY-----"
#: From BEGIN through END: header lines, then the body (the value), in which CR, blanks, escaped line feeds, quotes and
#: line prefixes may stand. No dash stands in a body, so a match never runs into another key. Without
#: an END the body ends with its last base64 line.
PEM = (r"-----BEGIN " + PEM_NAME
       + r"""(?:[\s\\nrt"',>#*|+]*+[A-Z][A-Za-z0-9-]{1,40}:\x20?[^\s\\]*+){0,8}"""
       + r"""([\s\\nrt"',>#*|+]*+[A-Za-z0-9+/=]{16}[A-Za-z0-9+/=\s\\"',>#*|]*+(?=-----END """ + PEM_NAME + r""")"""
       + r"""|[A-Za-z0-9+/=\r\n\\]*+(?:[\x20\x09]+[A-Za-z0-9+/=]{32,}[A-Za-z0-9+/=\r\n\\]*+){0,400})"""
       + r"""(?:-----END """ + PEM_NAME + r""")?""")
LOGIN = r"[a-z]{2,9}://[A-Za-z0-9_.-]{1,64}:([^\x20\x09-\x0D:/@]{3,})@"
#: What the scan looks for. KINDS stays as the SQL has it: there a key ends at its first other character.
SCANNED = tuple({"pem": ("pem", PEM, 1, 3), "login": ("login", LOGIN, 1, 3)}.get(kind[0], kind) for kind in KINDS)
PEM_NO = [kind for kind, *_ in KINDS].index("pem")


def _finds(text: Column, pattern: str, group: int) -> Column:
    """[(characters since the last match, characters of the match, value)], in order."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    rows = F.transform(F.arrays_zip(whole.alias("w"), gaps.alias("g"), values.alias("v")), lambda x: F.struct(
        x["g"].alias("gap"), F.length(x["w"]).alias("size"), x["v"].alias("value")))
    # the text after the last match is one more gap
    return F.when(text.rlike(pattern), F.filter(rows, lambda x: x["size"].isNotNull())).otherwise(
        F.array().cast("array<struct<gap:int,size:int,value:string>>"))


def _key_body(value: Column) -> Column:
    """The base64 characters of a key's body, so that line ends, indents and escapes make no other key of it."""
    return F.regexp_replace(F.regexp_replace(value, r"\\+[nrt]", ""), "[^A-Za-z0-9+/=]", "")


def find_candidates(docs: DataFrame, text: str, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """Two stored tables: rows (rid, `keep` columns), and finds (rid, kind_no, value, start, end).

    Offsets are code points, the end exclusive. Each kind's matches are leftmost and do not overlap.
    The value of a private key is its body without white space; a header without a body is no find.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    found = F.array(*[_finds(whole, pattern, group) for _, pattern, group, _ in SCANNED])
    rows = stored(docs.select(F.monotonically_increasing_id().alias("rid"), *keep, found.alias("found")), "secrets")
    kinds = rows.where("exists(found, f -> size(f) > 0)").select("rid", F.posexplode("found").alias("kind_no", "hits"))
    hits = kinds.select("rid", "kind_no", F.posexplode("hits").alias("pos", "hit")).select(
        "rid", "kind_no", "pos", "hit.*")
    until = Window.partitionBy("rid", "kind_no").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    hits = hits.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(until))
    hits = hits.withColumn("value", F.when(F.col("kind_no") == PEM_NO, _key_body(F.col("value"))).otherwise(F.col("value")))
    least = F.element_at(F.array(*[F.lit(n) for _, _, _, n in SCANNED]), F.col("kind_no") + 1)
    hits = hits.where(F.length("value") >= least).select(
        "rid", "kind_no", "value", (F.col("end") - F.col("size")).alias("start"), "end")
    return rows.drop("found"), hits


def ownership(hits: DataFrame, rows: DataFrame) -> DataFrame:
    """secret (SHA-256 of the value), owners, repositories, uses: over the whole corpus.

    Counted by (secret, owner, repository) first, so a value that a third of all texts hold
    reaches the second step as one row per owner and repository.
    """
    by = hits.join(rows.select("rid", "owner", "repository"), "rid").groupBy(
        F.sha2("value", 256).alias("secret"), "owner", "repository").agg(F.count("*").alias("uses"))
    by_owner = by.groupBy("secret", "owner").agg(
        F.count("*").alias("repositories"), F.sum("uses").alias("uses"))
    return by_owner.groupBy("secret").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"),
                                          F.sum("uses").alias("uses"))


def scan_secrets(docs: DataFrame, text: str = "text", owner: str = "source", repository: Column | None = None,
                 carry: list[str] | None = None, example_owners: int = 3) -> DataFrame:
    """One row per input row: the `carry` columns, and `secrets`, an array of finds in order.

    A find has start, end, kind_no, kind, secret (hash), owners, repositories and live. It is live
    with fewer than `example_owners` owners, otherwise a widely copied example. Finds beyond the
    base kinds are listed only when live. A null text is empty; a null owner is one owner, a null
    repository one repository; the repository defaults to the owner. Repeated rows are separate
    rows with the same finds.
    """
    carry = carry if carry is not None else [c for c in docs.columns if c != text]
    given = F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner")
    repo = F.col(owner) if repository is None else repository
    slim = docs.select(F.struct(*carry).alias("row"), given,
                       F.coalesce(repo.cast("string"), F.lit("")).alias("repository"), F.col(text).alias("_text"))
    rows, hits = find_candidates(slim, "_text", ["row", "owner", "repository"])
    known = ownership(hits, rows)
    live = F.col("owners") < example_owners
    name = F.element_at(F.array(*[F.lit(k) for k, *_ in KINDS]), F.col("kind_no") + 1)
    judged = hits.withColumn("secret", F.sha2("value", 256)).join(known, "secret").where(
        (F.col("kind_no") < BASE) | live)
    per_row = judged.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct(
        "start", "kind_no", "end", name.alias("kind"), "secret", "owners", "repositories", live.alias("live"))))
        .alias("secrets"))
    blank = F.array().cast(per_row.schema["secrets"].dataType)
    return rows.join(per_row, "rid", "left").select("row.*", F.coalesce("secrets", blank).alias("secrets"))


def redacted(text: Column, secrets: Column, mark: str = "[secret]") -> Column:
    """The text with every live find replaced by the mark; overlapping finds become one."""
    live = F.filter(secrets, lambda s: s["live"])
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    step = lambda a, s: F.when(s["end"] <= a["at"], a).otherwise(F.struct(
        F.concat(a["out"], F.substr(text, (a["at"] + 1).cast("int"),
                                    F.greatest(s["start"] - a["at"], F.lit(0)).cast("int")),
                 F.when(s["start"] >= a["at"], mark).otherwise("")).alias("out"), s["end"].alias("at")))
    done = F.aggregate(live, start, step, lambda a: F.concat(a["out"], F.substr(text, (a["at"] + 1).cast("int"))))
    return F.when(F.size(live) == 0, text).otherwise(done)


def span_digest(secrets: Column, base_only: bool) -> Column:
    """kind:start:end, comma-joined, in order of start and then kind."""
    some = F.filter(secrets, lambda s: s["kind_no"] < BASE) if base_only else secrets
    return F.array_join(F.transform(some, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
