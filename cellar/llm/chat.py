"""Chat formatting: schema fingerprints, canonical turns, a reversible template and a loss mask.

Records come in many layouts (prompt and completion, instruction with input,
lists of messages, one row per turn). Of a record's non-null nested field paths,
those that a mapping names are sorted and hashed; the first mapping, in the order
of ``LAYOUTS``, that allows the hash makes canonical turns (role, text) of the
record. So a field of a second layout does not cost the record.
Everything here is DataFrame functions; no Python runs on the executors.

Template of a turn: ``### <role>: <text></turn>\n``. Inside roles and texts the
control strings are escaped (``ESCAPES``): each backslash in an escaped string
starts one escape, so undoing them in the order below is exact, and a split at
``</turn>\n`` or the first ``: `` cannot meet content. The loss mask lists the
spans (code points) of the escaped assistant texts.

A conversation is formatted in parts of ``PART_TURNS`` consecutive turn numbers,
so a conversation that holds a large share of all rows is spread over many
tasks and sorted part by part; the parts in order are the conversation.

Null text reads as empty, null role as the empty role, null turn numbers come
first, null conversation ids form one conversation. Rows with the same turn
number are ordered by role and text; repeated rows are repeated turns. Fields
that the chosen mapping does not name are ignored. A record whose paths match no
mapping has a null layout and null turns: ``unmatched`` gives such records, and
formatting them is an error unless they are left out on purpose. Empty tables
give no rows.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: in the order in which they are applied; undone in reverse
ESCAPES = (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\t"), (":", "\\c"))
OPEN, AFTER_ROLE, CLOSE = "### ", ": ", "</turn>\n"
PART_TURNS = 64

#: layout: (fields it needs, fields it may have, (role, text) pairs in order). A path ``list[].field`` maps each entry of a list.
#: A text in the form ``a+b`` joins the fields a and b, where present, by an empty line; a role in the form ``=x`` is x itself.
LAYOUTS: dict[str, tuple[tuple[str, ...], tuple[str, ...], tuple[tuple[str, str], ...]]] = {
    "messages": (("messages[].role",), ("messages[].content",), (("messages[].role", "messages[].content"),)),
    "sharegpt": (("conversations[].from",), ("conversations[].value",), (("conversations[].from", "conversations[].value"),)),
    "instruction": (("instruction", "output"), ("input", "system"), (("=system", "system"), ("=user", "instruction+input"), ("=assistant", "output"))),
    "prompt": (("prompt", "completion"), ("system",), (("=system", "system"), ("=user", "prompt"), ("=assistant", "completion"))),
    "question": (("question", "answer"), ("system",), (("=system", "system"), ("=user", "question"), ("=assistant", "answer"))),
    "turn": ((), ("role", "text"), (("role", "text"),)),
}
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant"}  # of the sharegpt layout
JSON_SCHEMA = (
    "messages array<struct<role:string,content:string>>, conversations array<struct<`from`:string,value:string>>, instruction string, "
    "input string, output string, system string, prompt string, completion string, question string, answer string, role string, text string"
)


def fingerprint(paths: tuple[str, ...]) -> str:
    """Hash of a set of nested field paths."""
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def _known_paths() -> list[str]:
    return sorted({p for need, may, _ in LAYOUTS.values() for p in need + may})


def _fingerprints(layout: str) -> list[str]:
    """Fingerprints of the sets of its own paths that a layout allows."""
    need, may, _ = LAYOUTS[layout]
    least = 0 if need else 1  # a layout that needs nothing must find something
    return [fingerprint(need + extra) for n in range(least, len(may) + 1) for extra in combinations(may, n)]


def _typed_paths(df: DataFrame) -> set[str]:
    """Nested field paths of a frame's schema; ``[]`` stands for the entries of a list."""
    found = set()

    def walk(kind, path: str) -> None:
        found.add(path)
        if kind.typeName() == "array":
            walk(kind.elementType, path + "[]")
        elif kind.typeName() == "struct":
            for f in kind.fields:
                walk(f.dataType, f"{path}.{f.name}" if path else f.name)

    walk(df.schema, "")
    return found


def _present(path: str) -> Column:
    """The path itself if a record has a value there, else null."""
    if "[]." in path:
        top, field = path.split("[].")
        there = F.exists(F.col(f"`{top}`"), lambda x: x[field].isNotNull())
    else:
        there = F.col(f"`{path}`").isNotNull()
    return F.when(there, F.lit(path))


def _turns(layout: str, have: set[str]) -> Column:
    turns = []
    for role, text in LAYOUTS[layout][2]:
        if "[]." in role:
            top, role_field = role.split("[].")
            text_field = text.split("[].")[1]

            return F.transform(F.col(f"`{top}`"), lambda x: _turn(x[role_field], x[text_field] if text in have else F.lit("")))  # noqa: B023  (returned at once)
        parts = [F.col(f"`{p}`").cast("string") for p in text.split("+") if p in have]
        body = F.concat_ws("\n\n", *parts) if len(parts) > 1 else parts[0] if parts else F.lit(None).cast("string")
        turns.append(F.when(body.isNotNull() | F.lit(layout == "turn"), _turn(F.lit(role[1:]) if role[0] == "=" else F.col(role) if role in have else F.lit(None), body)))
    return F.filter(F.array(*turns), lambda t: t.isNotNull())


def _turn(role: Column, text: Column) -> Column:
    name = F.coalesce(role.cast("string"), F.lit(""))
    for old, new in ROLE_NAMES.items():
        name = F.when(name == old, F.lit(new)).otherwise(name)
    return F.struct(name.alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def canonical(records: DataFrame, into: str = "turns", layout: str = "layout") -> DataFrame:
    """``records`` with the name of the layout that their fingerprint selects and their canonical turns.

    The known paths are columns of ``records`` (see ``from_json``); columns
    named ``layout`` or ``turns`` are replaced.
    """
    have = _typed_paths(records)
    name, turns = F.lit(None).cast("string"), F.lit(None).cast("array<struct<role:string,text:string>>")
    known = [p for p in _known_paths() if p in have]
    nothing = F.size(F.array_compact(F.array(*[_present(p) for p in known]))) == 0 if known else F.lit(True)
    for x, (need, may, _) in reversed(LAYOUTS.items()):  # the first one is decided last and stays
        if not set(need) <= have:
            continue
        own_paths = [p for p in sorted(need + may) if p in have]
        print_ = F.sha2(F.array_join(F.array_compact(F.array(*[_present(p) for p in own_paths])), "\n"), 256) if own_paths else F.lit("")
        fits = print_.isin(_fingerprints(x)) | (nothing if not need else F.lit(False))  # a row of nulls is an empty turn
        name, turns = F.when(fits, F.lit(x)).otherwise(name), F.when(fits, _turns(x, have)).otherwise(turns)
    own = [c for c in records.columns if c.lower() not in (into.lower(), layout.lower())]
    return records.withColumn(layout, name).withColumn(into, turns).select(*[F.col(f"`{c}`") for c in own], layout, into)


def from_json(records: DataFrame, column: str) -> DataFrame:
    """The known fields of JSON records as columns, beside the other columns; their own columns of those names go."""
    names = {x.split(" ")[0].strip("` ").lower() for x in JSON_SCHEMA.replace("struct<role:string,content:string>", "").split(",")} | {"conversations"}
    own = [F.col(f"`{c}`") for c in records.columns if c.lower() not in names and c != column]
    return records.select(*own, F.from_json(F.col(column), JSON_SCHEMA).alias("_r")).select(*[F.col(f"`{c}`") for c in records.columns if c.lower() not in names and c != column], "_r.*")


def unmatched(records: DataFrame) -> DataFrame:
    """The records that no layout fits, as they are."""
    return canonical(records, "_turns", "_layout").where(F.col("_layout").isNull()).select(*[F.col(f"`{c}`") for c in records.columns])


def escape(x: Column) -> Column:
    for old, new in ESCAPES:
        x = F.replace(x, F.lit(old), F.lit(new))
    return x


def unescape(x: Column) -> Column:
    for old, new in reversed(ESCAPES):
        x = F.replace(x, F.lit(new), F.lit(old))
    return x


def format_parts(rows: DataFrame, id: str = "conv_id", turn: str = "turn", skip_unmatched: bool = False) -> DataFrame:
    """Format turns (columns ``id``, ``turn`` and those that a layout names): one row per conversation and part.

    Columns: id, part, text (formatted), loss: spans (first code point from 0, length) of the assistant texts.
    A record that no layout fits is an error when it is met; with ``skip_unmatched`` it is left to ``unmatched``.
    """
    one = canonical(rows, "_turns", "_layout")
    if skip_unmatched:
        one = one.where(F.col("_layout").isNotNull())
    else:
        error = F.raise_error(F.lit("a record fits no chat layout: see unmatched()")).cast("array<struct<role:string,text:string>>")
        one = one.withColumn("_turns", F.when(F.col("_layout").isNull(), error).otherwise(F.col("_turns")))
    number = F.col(turn).cast("bigint")
    # a record's turns stay in its order; records of the same turn number go by their turns
    one = one.select(F.col(id), F.floor(number / PART_TURNS).alias("part"), number.alias("n"), F.col("_turns").alias("t"))
    parts = one.groupBy(id, "part").agg(F.sort_array(F.collect_list(F.struct("n", "t"))).alias("turns"))
    parts = parts.withColumn("turns", F.flatten("turns.t"))
    body = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(OPEN), escape(t["role"]), F.lit(AFTER_ROLE)).alias("head"), escape(t["text"]).alias("body"), (t["role"] == "assistant").alias("loss")
        ),
    )
    parts = parts.select(id, "part", body.alias("b"))
    sizes = F.transform("b", lambda x: F.char_length(x["head"]) + F.char_length(x["body"]) + len(CLOSE))
    parts = parts.withColumn("sizes", sizes)
    spans = F.transform(
        "b",
        lambda x, i: F.struct(
            (F.aggregate(F.slice("sizes", F.lit(1), i), F.lit(0).cast("bigint"), lambda s, y: s + y) + F.char_length(x["head"])).alias("first"),
            F.char_length(x["body"]).cast("bigint").alias("length"),
            x["loss"].alias("loss"),
        ),
    )
    loss = F.transform(F.filter(spans, lambda s: s["loss"]), lambda s: F.struct(s["first"], s["length"]))
    text = F.array_join(F.transform("b", lambda x: F.concat(x["head"], x["body"], F.lit(CLOSE))), "")
    return parts.select(id, "part", text.alias("text"), loss.alias("loss"))


def join_parts(parts: DataFrame, id: str = "conv_id") -> DataFrame:
    """One row per conversation: id, text (all parts), loss (spans in the whole text)."""
    from pyspark.sql import Window

    before = Window.partitionBy(id).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.withColumn("_at", F.coalesce(F.sum(F.char_length("text")).over(before), F.lit(0)))
    placed = placed.withColumn("loss", F.transform("loss", lambda s: F.struct((s["first"] + F.col("_at")).alias("first"), s["length"])))
    rows = placed.groupBy(id).agg(F.sort_array(F.collect_list(F.struct("part", "text", "loss"))).alias("p"))
    return rows.select(id, F.array_join("p.text", "").alias("text"), F.flatten("p.loss").alias("loss"))


def read_back(parts: DataFrame) -> DataFrame:
    """``parts`` with the turns (role, text) parsed from their text, and ``loss_text``: what the loss mask covers, unescaped."""
    pieces = F.slice(F.split("text", CLOSE, -1), 1, F.size(F.split("text", CLOSE, -1)) - 1)

    def turn(x: Column) -> Column:
        role = F.substring_index(F.substr(x, F.lit(len(OPEN) + 1)), AFTER_ROLE, 1)
        text = F.substr(x, F.char_length(role) + len(OPEN) + len(AFTER_ROLE) + 1)
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    lost = F.transform("loss", lambda s: unescape(F.substr(F.col("text"), (s["first"] + 1).cast("int"), s["length"].cast("int"))))
    return parts.withColumn("turns", F.transform(pieces, turn)).withColumn("loss_text", F.array_join(lost, ""))


def digests(parts: DataFrame, id: str = "conv_id") -> DataFrame:
    """Per conversation, read back from the formatted parts: counts and digests of its turns and of the text under the mask."""
    back = read_back(parts).select(
        id,
        "part",
        F.size("turns").alias("n"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
        "loss_text",
        F.char_length("text").alias("chars"),
    )
    one = back.groupBy(id).agg(
        F.sum("n").cast("bigint").alias("n_turns"),
        F.sum("chars").cast("bigint").alias("formatted_chars"),
        F.sum(F.char_length("loss_text")).cast("bigint").alias("loss_chars"),
        F.sort_array(F.collect_list(F.struct("part", "turns", "loss_text"))).alias("p"),
    )
    return one.select(
        id,
        "n_turns",
        F.sha2(F.array_join("p.turns", ""), 256).alias("turns_sha256"),
        "loss_chars",
        F.sha2(F.array_join("p.loss_text", ""), 256).alias("loss_sha256"),
        "formatted_chars",
    )
