"""Secret scans with an incremental blob ledger; DataFrame functions only.

Every version of every path is content-addressed. The ledger holds the (blob, rule version) pairs that were
scanned; a scan reads the text of one carrier per unseen pair, appends spans and pairs, and findings join back to
all paths that ever held the blob. A blob found under thousands of paths is thus scanned once.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidelake.llm.common import spread_join
from tidelake.session import checkpointed

SPAN = "array<struct<start: int, rank: int, kind: string, end: int>>"


@dataclass(frozen=True)
class Rule:
    """One kind of secret. ``group`` must hold at least ``least`` code points, else the match is dropped."""
    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = True


#: Base rules in their listed order, then what this library adds. Raise a rule's version whenever it changes.
#: A greedy run that is too short holds no long one, so the least length of access and hex stands in the pattern.
RULES = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, False),
    Rule("bearer", 1, r"(?i)bearer\x20+([A-Za-z0-9._~+/=-]+)", 1, 20, False),
)

#: A private key whole: to its END line, which no other five dashes precede, or where that is missing over the lines of base64, and
#: headers of the key, that follow; line ends may be escaped or quoted. Possessive groups need no stack, however long the key is.
_BREAK = r"""(?:[\s"'+,>]|\\[nrt])*+"""
_LINE = r"(?:(?:Proc-Type|DEK-Info):[^\r\n\\]*+|[A-Za-z0-9+/]{16,}+={0,2}+)"
_LAST = r"[A-Za-z0-9+/]{1,15}+={0,2}+"
WHOLE_KEY = (r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?:[^-]++|-(?!----))*+-----END [A-Z ]*PRIVATE KEY-----"
             rf"|(?:(?:{_BREAK}{_LINE})++(?:{_BREAK}{_LAST})?+)?+)")
#: The rules for redaction. RULES tells where a key begins, as its SQL does; what is replaced must hold the key itself.
REDACTION_RULES = tuple(replace(r, version=r.version + 1, pattern=WHOLE_KEY) if r.kind == "pem" else r for r in RULES)


def spans(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of one rule, in code points, end exclusive.

    The pieces between matches and the matches themselves alternate, so running lengths give the positions.
    """
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    kept = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    gaps = F.split(text, rule.pattern, -1)
    steps = F.arrays_zip(F.transform(gaps, F.length).alias("gap"), F.transform(whole, F.length).alias("size"),
                         F.transform(kept, F.length).alias("kept"))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("found"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        end = start + F.coalesce(x["size"], F.lit(0))
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), end.alias("end"))
        fits = F.coalesce(x["kept"] >= rule.least, F.lit(False))
        return F.struct(end.alias("at"), F.when(fits, F.concat(state["found"], F.array(span))).otherwise(state["found"])
                        .alias("found"))

    found = F.aggregate(steps, empty, step, lambda s: s["found"])
    return F.when(F.coalesce(F.rlike(text, F.lit(rule.pattern)), F.lit(False)), found).otherwise(
        F.array().cast(SPAN))


def suspected(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Whether any rule matches at all; a match may still be too short to be kept."""
    return reduce(lambda a, b: a | b, [F.rlike(text, F.lit(rule.pattern)) for rule in rules])


def version_of(rules: tuple[Rule, ...]) -> str:
    return ",".join(f"{r.kind}:{r.version}" for r in rules)


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, spans) of each (blob, content)."""
    found = F.concat(*[spans(F.col("content"), rule, rank) for rank, rule in enumerate(rules)])
    return blobs.select("blob", F.array_sort(found).alias("spans"))


def addressed(versions: DataFrame, text: str = "text") -> DataFrame:
    """Versions with their blob, the SHA-256 of the content; null content is the empty text."""
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return versions.withColumns({"content": content, "blob": F.unhex(F.sha2(content, 256))})


def unseen(versions: DataFrame, path: str, ledger: DataFrame | None, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, content) of one carrier for each blob that the ledger lacks at this rule version.

    Carriers are found on digests alone; texts move once, keyed by path and blob, so that a blob with a third of
    all paths never meets in one task.
    """
    carriers = versions.groupBy("blob").agg(F.min(F.struct(F.col(path).isNull().alias("none"), F.col(path).alias("path")))
                                            .alias("first")).select("blob", "first.path")
    if ledger is not None:
        seen = ledger.where(F.col("rules") == version_of(rules)).select("blob")
        carriers = carriers.join(seen, "blob", "left_anti")
    carriers = carriers.select(F.col("blob").alias("carried"), F.col("path").alias("carrier")).hint("shuffle_hash")
    same = (F.col("blob") == F.col("carried")) & F.col(path).eqNullSafe(F.col("carrier"))
    return versions.join(carriers, same, "left_semi").select("blob", "content")


def scan(versions: DataFrame, path: str = "path", text: str = "text", ledger: DataFrame | None = None,
         rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """Scan what the ledger lacks: (paths with their blob, new ledger rows (blob, rules, spans)).

    ``ledger`` holds the rows of earlier scans, or is None. Append the second result to it. Null and empty
    contents are blobs like any other and have no spans; a path given twice with the same content yields two rows
    with the same blob, which is scanned once. An empty table gives empty results.
    """
    at = addressed(versions.select(F.col(f"`{path}`").alias("path"), F.col(f"`{text}`").alias("text")))
    new = scan_blobs(unseen(at, "path", ledger, rules), rules)
    return at.select("path", "blob"), new.select("blob", F.lit(version_of(rules)).alias("rules"), "spans").dropDuplicates(["blob"])


def scan_in_parts(versions: DataFrame, path: str, earlier: Column, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """All paths and their ledger, as after two scans: of the ``earlier`` rows, then of the others against the first scan's ledger."""
    early = F.coalesce(earlier, F.lit(False))
    old_paths, ledger = scan(versions.where(early), path, rules=rules)
    ledger = checkpointed(ledger)
    paths, new = scan(versions.where(~early), path, ledger=ledger, rules=rules)
    return old_paths.unionByName(paths), ledger.unionByName(checkpointed(new))


def findings(paths: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Spans of every path by these rules: all paths, with an empty list where the blob holds nothing.

    The ledger may hold rows of other rule versions, which are not read. A blob that a third of all paths hold meets its spans by broadcast, see ``spread_join``.
    """
    held = checkpointed(ledger.where((F.col("rules") == version_of(rules)) & (F.size("spans") > 0)).select(
        F.col("blob").alias("found"), "spans"))
    joined = spread_join(checkpointed(paths), held, "blob", "found")
    return joined.select("path", "blob", F.coalesce("spans", F.array().cast(SPAN)).alias("spans"))


def joined_spans(found: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, found: Column, mark: str = "[secret]") -> Column:
    """The text with each span, or union of overlapping spans, replaced by a mark."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(state: Column, s: Column) -> Column:
        piece = F.concat(F.substring(text, state["at"] + 1, s["start"] - state["at"]), F.lit(mark))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"),
                        F.when(s["start"] >= state["at"], F.concat(state["out"], F.array(piece))).otherwise(state["out"])
                        .alias("out"))

    return F.when(F.size(found) == 0, text).otherwise(F.aggregate(
        found, start, step,
        lambda s: F.concat(F.array_join(s["out"], ""), F.substring(text, s["at"] + 1, F.length(text)))))
