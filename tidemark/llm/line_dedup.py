"""Operator 6: line deduplication with a log-template tree, in DataFrame functions only.

A line is parsed like a log message: its fields are the runs of non-white-space (of Unicode), each character of a script that
is written without spaces is a field of its own, and a field with a digit is variable (``<*>``).
A tree of fixed depth leads to a node by the number of fields and the first ``LEADS[0]`` of them. In a node the fields are
compared by position: the most frequent field of each position makes a template, and lines that agree with it in
``SIMILAR`` or more of their fields are its instances -- the positions in which they differ are variable too. The lines that
are no instance vote again, in a node of ``LEADS[1]`` leading fields, and those that are still none once more in
one of ``LEADS[2]``: so a leaf holds two templates of its own, and a crowded one those of its children. A line that is no
instance in any vote stands for itself, with its digits generalised; one of fewer than ``LEADS[0]`` fields always does. A template that occurs in two documents or more is
recurring: it is kept in the first document (by id) and its lines are dropped from all others.

Leaves that one document alone has are dropped before any field is looked at, and nodes of one document or one line cast no vote. Equal lines meet in partial sums
before they are shuffled, so a line that a third of the documents have is one row per task; only positions of lines, not
texts, are joined with the decisions.

Edge cases: a document is named by its id, so rows that share an id are one document and are no recurrence to each other; a NULL id is
replaced by the text's hash; blank lines are never dropped, nor are lines of fewer than ``LEADS[0]`` fields that have no
letter outside their variable fields (numbers, brackets, rules); a NULL text stays
NULL and an empty one empty; a text that loses all its lines becomes empty, its row stays; ties between fields go to the
greater string; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, new_name, release_shuffles

LEADS = (3, 3, 6)  # leading fields that name a line's node, by vote
SIMILAR = 0.8
LINKED = 0.8
SHINGLE = 5
VARIABLE = "<*>"
_WHITE = " \t\x0b\f\r"
_WIDE_WHITE = r"[\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"  # category Z beyond ASCII
_UNSPACED = "[" + "".join(rf"\p{{Is{s}}}" for s in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar")) + "]"  # written without spaces
_MAYBE = r"[\x{85}\x{A0}\x{E00}-\x{10FFFF}]"  # holds both


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def document_key() -> list[Column]:
    """_did names the document, _th the row's text."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text")).alias("_did"), F.xxhash64("text").alias("_th")]


def masked(raw: Column) -> Column:
    """The line with one space between fields and every field with a digit as ``<*>``."""
    wide = (F.octet_length(raw) > F.length(raw)) & raw.rlike(_MAYBE)  # most lines are ASCII or of letters with accents
    opened = F.when(wide, F.regexp_replace(F.regexp_replace(raw, _WIDE_WHITE, " "), _UNSPACED, " $0 ")).otherwise(raw)

    def of(line: Column) -> Column:
        spaced = F.regexp_replace(line, r"[ \t\x0B\f\r]+", " ")
        plain = ~(line.rlike(r"[0-9\t\x0B\f\r]") | line.contains("  "))  # most lines: nothing to replace
        return F.when(plain, line).otherwise(F.regexp_replace(spaced, r"[^ ]*[0-9][^ ]*", VARIABLE))
    return let(F.trim(opened, F.lit(_WHITE)), of)


def node(line: Column, fields: Column, lead: int) -> Column:
    """The tree's node: the number of fields and the first ``lead`` of them."""
    return F.xxhash64(fields, F.substring_index(line, " ", lead))


def parsed(raw: Column) -> Column:
    """(line, leaf) of a raw line; NULL if it is blank, or short and without a letter."""
    def of(line: Column) -> Column:
        fields = F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1
        return let(fields, lambda n: F.when((n >= LEADS[0]) | line.rlike(r"\p{L}"), F.struct(
            line.alias("line"), node(line, n, LEADS[0]).alias("leaf"))))
    return let(masked(raw), of)


def parsed_lines(docs: DataFrame) -> DataFrame:
    """(_did, _th, pos, line, leaf) of every line that may be dropped; each line is parsed once, before the rows are made."""
    lines = docs.where("text IS NOT NULL").select(
        *document_key(), F.posexplode(F.transform(F.split("text", "\n"), parsed)).alias("pos", "_line"))
    return lines.where("_line IS NOT NULL").select("_did", "_th", "pos", "_line.line", "_line.leaf")


def recurring_leaves(lines: DataFrame) -> DataFrame:
    """Leaves that two documents have."""
    return lines.groupBy("leaf").agg(F.min("_did").alias("a"), F.max("_did").alias("b")).where("a <> b").select("leaf")


def node_templates(lines: DataFrame) -> DataFrame:
    """(node, template): the most frequent field of each position, for nodes with different lines and documents.

    ``lines``: (node, line, n, least, most).
    """
    mixed = (lines.groupBy("node").agg(F.min("line").alias("a"), F.max("line").alias("b"), F.min("least").alias("c"), F.max("most").alias("d"))
             .where("a <> b AND c <> d").select("node"))
    fields = (lines.join(mixed, "node", "left_semi").select("node", "n", F.posexplode(F.split("line", " ")).alias("at", "field"))
              .groupBy("node", "at", "field").agg(F.sum("n").alias("n")))
    usual = fields.groupBy("node", "at").agg(F.max(F.struct("n", "field")).alias("top"))
    # A template has as many fields as a line of its node.
    return usual.groupBy("node").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "top.field"))), lambda x: x["field"]).alias("template"))


def decisions(lines: DataFrame, similar: float) -> DataFrame:
    """(leaf, line, first): the lines of recurring templates and the first document that has the template.

    ``lines``: (leaf, line, n, least, most) -- distinct lines with their number, first and last document.
    """
    fields = F.split("line", " ")
    agree = F.size(F.filter(F.zip_with(fields, F.col("template"), lambda a, b: a == b), lambda x: x)) >= similar * F.size(fields)
    voters, instances = lines, None
    for vote, lead in enumerate(LEADS):
        voters = voters.withColumn("node", F.col("leaf") if lead == LEADS[0] else node(F.col("line"), F.size(fields), lead))
        judged = materialize(voters.join(node_templates(voters), "node").withColumn("agrees", agree).drop("template"), "judged-lines")
        won = judged.where("agrees").select(F.lit(vote).alias("vote"), "node", "leaf", "line", "least", "most")
        instances = won if instances is None else instances.unionAll(won)
        voters = judged.where("NOT agrees").drop("node", "agrees")
    template = ["vote", "node"]
    whole = instances.groupBy(template).agg(F.min("least").alias("first"), F.max("most").alias("last")).where("first <> last").drop("last")
    # A line that is no instance of any template stands for itself.
    alone = lines.where("least <> most").join(instances.select("leaf", "line"), ["leaf", "line"], "left_anti")
    return (instances.join(whole, template).select("leaf", "line", "first")
            .unionAll(alone.select("leaf", "line", F.col("least").alias("first"))))


def without(text: Column, gone: Column) -> Column:
    """``text`` without the lines at the positions ``gone``."""
    def of(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    return let(F.split(text, "\n"), of)


def shingle_hashes(text: Column) -> Column:
    """The distinct hashes of five consecutive words (all words of a shorter text), as the document join takes them."""
    words = F.filter(F.split(F.lower(text), r"[\s\x1c-\x1f\x85\p{Z}]+"), lambda w: w != "")
    return let(words, lambda w: F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(w) - SHINGLE + 1, F.lit(1))), lambda i: F.xxhash64(F.slice(w, i, SHINGLE))))))


def copies(docs: DataFrame, rows: DataFrame, copy_share: float, linked: float) -> DataFrame:
    """(_did, _th) of the documents that are shown to be near copies of the one document most of their lines come from.

    ``rows``: (_did, _th, dropped, original, shared). Lines to drop make up ``copy_share`` of such a document's characters, and what it
    keeps of them (the original's) and what the original keeps have a Jaccard similarity of ``linked`` or more. The original
    is no such document itself, so what it keeps is certain.
    """
    keyed = docs.where("text IS NOT NULL").select(*document_key(), "text")
    lines = F.split("text", "\n")
    chars = F.aggregate("dropped", F.lit(0), lambda n, i: n + F.length(F.get(lines, i)))
    many = F.coalesce(chars >= copy_share * (F.length("text") - F.size(lines) + 1), F.lit(False))
    suspects = materialize(keyed.join(rows, ["_did", "_th"]).where(many).dropDuplicates(["_did", "_th"]).select(
        "_did", "_th", "original", shingle_hashes(without(F.col("text"), F.array_except("dropped", "shared"))).alias("grams")), "suspected-copies")
    release_shuffles(docs.sparkSession)  # of all texts
    none = F.array().cast("array<int>")
    originals = (keyed.join(suspects.select(F.col("original").alias("_did")).distinct(), "_did", "left_semi")
                 .dropDuplicates(["_did", "_th"]).join(rows, ["_did", "_th"], "left").where(~many)
                 .select(F.col("_did").alias("original"), shingle_hashes(without(F.col("text"), F.coalesce("dropped", none))).alias("of")))
    originals = materialize(originals, "originals")
    release_shuffles(docs.sparkSession)
    common = F.size(F.array_intersect("grams", "of"))
    return (suspects.join(originals, "original")
            .where((common > 0) & (common >= linked * (F.size("grams") + F.size("of") - common))).select("_did", "_th").distinct())


def dropped_lines(docs: DataFrame, *, similar: float = SIMILAR, copy_share: float | None = None, linked: float = LINKED) -> DataFrame:
    """(_did, _th, dropped): the positions of the lines to drop, for each row that has any."""
    lines = parsed_lines(docs)
    # Only lines that may recur are looked at more closely; they are a small part of the texts.
    likely = materialize(lines.join(recurring_leaves(lines), "leaf", "left_semi"), "recurring-lines")
    distinct = likely.groupBy("leaf", "line").agg(F.count("*").alias("n"), F.min("_did").alias("least"), F.max("_did").alias("most"))
    release_shuffles(docs.sparkSession)  # of all lines; the rest reads the tables
    decided = materialize(decisions(materialize(distinct, "distinct-lines"), similar), "recurring-templates")
    places = likely.join(decided, ["leaf", "line"]).where(F.col("_did") != F.col("first"))
    release_shuffles(docs.sparkSession)
    if copy_share is None:
        return places.groupBy("_did", "_th").agg(F.collect_set("pos").alias("dropped"))
    # Lines by the document that keeps them; the one that keeps most of the characters is the original, if it is a copy.
    by_first = places.groupBy("_did", "_th", "first").agg(F.sum(F.length("line")).alias("chars"), F.collect_set("pos").alias("at"))
    by_row = by_first.groupBy("_did", "_th").agg(F.max(F.struct("chars", "first", "at")).alias("most"), F.flatten(F.collect_list("at")).alias("dropped"))
    rows = materialize(by_row.select("_did", "_th", "dropped", F.col("most.first").alias("original"), F.col("most.at").alias("shared")), "dropped-lines")
    shown = copies(docs, rows, copy_share, linked).withColumn("copy", F.lit(True))
    return rows.join(shown, ["_did", "_th"], "left").select(
        "_did", "_th", F.when(F.col("copy"), F.array_except("dropped", "shared")).otherwise(F.col("dropped")).alias("dropped"))


def dedup_lines(docs: DataFrame, *, similar: float = SIMILAR, copy_share: float | None = None, linked: float = LINKED) -> DataFrame:
    """``docs`` without the lines of recurring templates, with the same columns and, as the last two, ``_n_lines`` and ``_n_dropped`` (with
    further underscores if ``docs`` has columns of these names).

    ``copy_share``: a document of which the lines to drop make up this share of its characters or more keeps those that it has from one other
    document if it is shown to be a near copy of it (Jaccard similarity of ``linked`` or more, of what both keep): it is then a
    matter for document deduplication. All other documents lose all their recurring lines.
    """
    did, th, gone = (new_name(c, docs) for c in ("_tm_did", "_tm_th", "_tm_dropped"))
    keyed = docs.withColumns(dict(zip((did, th), document_key())))
    dropped = dropped_lines(docs.select("doc_id", "text"), similar=similar, copy_share=copy_share, linked=linked).toDF(did, th, gone)
    joined = keyed.join(dropped, [did, th], "left").withColumn(gone, F.coalesce(gone, F.array().cast("array<int>")))
    text = F.when(F.size(gone) == 0, F.col("text")).otherwise(without(F.col("text"), F.col(gone)))
    counts = [F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias(new_name("_n_lines", docs)),
              F.size(gone).cast("long").alias(new_name("_n_dropped", docs))]
    return joined.select(*(text.alias("text") if c == "text" else F.col(c) for c in docs.columns), *counts)
