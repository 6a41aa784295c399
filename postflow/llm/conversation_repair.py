"""Repair of conversation structure: faults, gaps, and the cheapest edits by iterative deepening.

The search needs a letter per row, not the texts. So rows go to it as an order, a digest and a
class; its edits come back as rows, meet the texts in one sort, and are carried out while the
conversation streams by. Texts are shuffled once, and no conversation is ever held as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postflow.llm.batches import slices
from postflow.llm.edit_search import LEGAL, cheapest

# Fixed values of the contract.
BLANK = " \t\n\x0b\f\r"
CLOSING = ".!?"
ROLES = {"u": "user", "a": "assistant"}
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

ORDER = ["conv_id", "part", "turn", "role", "sha", "kind"]
HEAD, ROW = 0, 1  # part: what is known of the whole conversation, then its rows
EDIT, TEXT = 0, 1  # kind: a row's edit comes right before its text
KEY_SCHEMA = "part int, turn long, role string, sha binary, kind int"


def filled_rows(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text: null roles and texts are one space."""
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"),
                       F.coalesce("role", F.lit(" ")).alias("role"),
                       F.coalesce("text", F.lit(" ")).alias("text"))


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage, by a hash of conversation and turn: conv_id, turn, role, text, times
    (how often the row stands there: 0 if it was dropped)."""
    def told(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    hit = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn"))) % 20
    return filled_rows(rows).withColumn("hit", hit).select(
        "conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("hit") == 1, "")
        .when(F.col("hit") == 2, F.translate("text", CLOSING, ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(F.col("hit") == 0, 0).when(F.col("hit") == 3, 2).otherwise(1).alias("times"))


def keyed(rows: DataFrame) -> DataFrame:
    """Rows with the digest that stands for their text."""
    return rows.withColumn("part", F.lit(ROW)).withColumn(
        "sha", F.unhex(F.sha2("text", 256)))


def classed(rows: DataFrame) -> DataFrame:
    """What the search needs of each row: its order and its class, ``x`` if it is blank."""
    bare = F.rtrim(F.col("text"), F.lit(BLANK))
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    closed = F.substring(bare, -1, 1).isin(*CLOSING)
    return keyed(rows).select(
        "conv_id", "turn", "role", "sha", "times", known.alias("initial"),
        F.when(F.trim(F.col("text"), F.lit(BLANK)) == "", "x").when(closed, known)
        .otherwise(F.upper(known)).alias("class"))


def decide(rows: list[tuple]) -> tuple[list[int], str, list[tuple]]:
    """Counts, audit and edits of one conversation, from (turn, role, sha, initial, class) in
    order. An edit is (turn, role, sha, roles inserted before the row, its new role or None); the
    last one, for what is inserted at the end, has no key."""
    seen, classes = set(), []
    blank = duplicate = illegal = 0
    before = None
    for _, role, sha, initial, one in rows:
        if before is not None and before + initial not in LEGAL:
            illegal += 1
        before = initial
        if one == "x":
            blank += 1
        elif (role, sha) in seen:
            duplicate += 1
            one = "x"
        seen.add((role, sha))
        classes.append(one)
    classes = "".join(classes)
    truncated = sum(map(str.isupper, classes))
    turns = {row[0] for row in rows} - {None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    audit, cost = cheapest(classes)
    edits, inserted, last, at = [], "", "", 0
    for letter in audit:
        if letter == "D":
            at += 1
            continue
        last = classes[at] if letter == "K" else "a" if last == "u" else "u"
        last = last.lower()
        if letter == "I":
            inserted += last
            continue
        edits.append((*rows[at][:3], inserted, None if letter == "K" else ROLES[last]))
        inserted = ""
        at += 1
    edits.append((None, None, None, inserted, None))
    return [gaps, blank, duplicate, truncated, illegal, cost], audit, edits


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[tuple]]]:
    """Conversations of a sorted partition, one after another, as rows repeated ``times``."""
    held: list[tuple] = []
    current: object = grouped  # no id is this
    for batch in batches:
        columns = [batch.column(x).to_pylist() for x in
                   ("conv_id", "turn", "role", "sha", "initial", "class", "times")]
        for conv, *row, times in zip(*columns):
            if conv != current:
                if current is not grouped:
                    yield current, held
                current, held = conv, []
            held.extend([tuple(row)] * times)
    if current is not grouped:
        yield current, held


def edits_of(rows: DataFrame) -> DataFrame:
    """The search over every conversation: a head row each (counts, audit, roles inserted at the
    end), and a row for each row that stays (roles inserted before it, its new role)."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = (f"conv_id {kind}, {KEY_SCHEMA}, inserted string, new_role string, audit string, "
              "counts array<long>")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = []
        for conv, held in grouped(batches):
            counts, audit, edits = decide(held)
            *stay, (_, _, _, tail, _) = edits
            out.append([conv, HEAD, None, None, None, EDIT, tail, None, audit, counts])
            for turn, role, sha, inserted, new in stay:
                out.append([conv, ROW, turn, role, sha, EDIT, inserted, new, None, None])
                if len(out) >= 20_000:
                    yield packed(out, pa_schema)
                    out = []
        if out:
            yield packed(out, pa_schema)

    spark = rows.sparkSession
    pa_schema = arrow_schema(spark, schema)
    return (classed(rows).repartition("conv_id")
            .sortWithinPartitions("conv_id", "turn", "role", "sha").mapInArrow(search, schema))


def arrow_schema(spark, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], schema).schema)


def packed(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(zip(*rows), schema)], schema=schema)


def met(rows: DataFrame) -> DataFrame:
    """Edits and texts of a conversation in one task, each edit right before its row's text."""
    edits = edits_of(rows).withColumn("text", F.lit(None).cast("string"))
    texts = keyed(rows.filter((F.col("times") > 0) & (F.trim(F.col("text"), F.lit(BLANK)) != "")))
    empty = [F.lit(None).cast(t).alias(x) for x, t in
             (("inserted", "string"), ("new_role", "string"), ("audit", "string"),
              ("counts", "array<long>"))]
    texts = texts.select("conv_id", "part", "turn", "role", "sha", F.lit(TEXT).alias("kind"),
                         *empty, "text")
    return edits.unionByName(texts).repartition("conv_id").sortWithinPartitions(*ORDER)


def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """("head", conv_id, audit, counts), then ("turn", role, text, letter) of each turn of the
    repaired conversation, for one conversation after another."""
    tail, edit = "", None
    started = False
    for whole in batches:
        for batch in slices(whole, "text"):
            columns = [batch.column(x).to_pylist() for x in (
                *ORDER, "inserted", "new_role", "audit", "counts", "text")]
            for conv, part, turn, role, sha, kind, inserted, new, audit, counts, text in zip(
                    *columns):
                if part == HEAD:
                    if started:
                        yield from (("turn", ROLES[x], "", "I") for x in tail)
                    started, tail, edit = True, inserted, None
                    yield "head", conv, audit, counts
                elif kind == EDIT:
                    if edit is not None:
                        raise RuntimeError(f"no text for an edit of conversation {conv}")
                    edit = (turn, role, sha, inserted, new)
                elif edit is not None and edit[:3] == (turn, role, sha):
                    yield from (("turn", ROLES[x], "", "I") for x in edit[3])
                    yield "turn", edit[4] or role, text, "R" if edit[4] else "K"
                    edit = None
    if started:
        yield from (("turn", ROLES[x], "", "I") for x in tail)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, position (from 0), role, text, edit (K, R or I).

    ``rows`` has conv_id, turn, role, text and times (see ``as_rows``). Rows stand in order of turn
    (nulls first), then role, then the text's SHA-256. A row's first fault counts: blank (no
    character outside ``[\\x20\\x09-\\x0D]``), duplicate (role and text seen earlier), truncated
    (its last such character is none of ``.!?``). A null conv_id is one conversation; texts of any
    length pass as they are; an empty table gives an empty result; other columns are not read. A
    conversation streams through one task; the search holds a class, an order and a digest per row.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, position long, role string, text string, edit string"
    pa_schema = arrow_schema(rows.sparkSession, schema)

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size, conv, position = [], 0, None, 0
        for what, first, second, third in walked(batches):
            if what == "head":
                conv, position = first, 0
                continue
            out.append((conv, position, first, second, third))
            position, size = position + 1, size + len(second) + 100
            if size > 4_000_000:
                yield packed(out, pa_schema)
                out, size = [], 0
        if out:
            yield packed(out, pa_schema)

    return met(rows).mapInArrow(turns, schema)


def repair_report(rows: DataFrame) -> DataFrame:
    """One row per conversation, also those without rows (``times`` 0): conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256 (the turns as ``role:text``, joined
    by line breaks). Rows as for ``repaired_turns``."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = (f"conv_id {kind}, " + "".join(f"{x} long, " for x in COUNTS)
              + "audit string, repaired_sha256 string")
    pa_schema = arrow_schema(rows.sparkSession, schema)

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held, sha, first = [], None, None, True
        for what, *told in walked(batches):
            if what == "head":
                if held is not None:
                    out.append((*held, sha.hexdigest()))
                    if len(out) >= 10_000:
                        yield packed(out, pa_schema)
                        out = []
                conv, audit, counts = told
                held, sha, first = (conv, *counts, audit), hashlib.sha256(), True
                continue
            role, text, _ = told
            sha.update(f"{'' if first else chr(10)}{role}:".encode())
            sha.update(text.encode())
            first = False
        if held is not None:
            out.append((*held, sha.hexdigest()))
        if out:
            yield packed(out, pa_schema)

    return met(rows).mapInArrow(report, schema)


def as_rows(rows: DataFrame) -> DataFrame:
    """Conversations as they are, for the functions above."""
    return filled_rows(rows).withColumn("times", F.lit(1))
