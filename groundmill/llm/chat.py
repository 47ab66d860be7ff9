"""Chat formatting: field-path fingerprints choose the mapping that turns any known layout into turns."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import combinations
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURN = "struct<turn:bigint,role:string,text:string>"
OPEN, CLOSE, END = "[INST]", "[/INST]", "</s>"


@dataclass(frozen=True)
class Layout:
    """One known layout: the nested field paths that tell it, and SQL expressions that give its turns."""

    name: str
    paths: tuple[str, ...]
    conv_id: str
    turns: str
    #: One row is one turn, and rows of a conversation are to be gathered.
    rows: bool = False

    @property
    def filled(self) -> frozenset[str]:
        """The columns that hold a record's texts."""
        return frozenset(p.split(".")[0].removesuffix("[]") for p in self.paths) - {self.conv_id}

    @property
    def fingerprint(self) -> str:
        return _digest(self.paths)


def _turn(n: str, role: str, text: str) -> str:
    return f"named_struct('turn', CAST({n} AS BIGINT), 'role', CAST({role} AS STRING), 'text', CAST({text} AS STRING))"


LAYOUTS = (
    Layout("turn rows", ("conv_id", "role", "text", "turn"), "conv_id", f"array({_turn('turn', 'role', 'text')})", rows=True),
    Layout("prompt", ("completion", "id", "prompt"), "id", f"array({_turn('0', chr(39) + 'user' + chr(39), 'prompt')}, {_turn('1', chr(39) + 'assistant' + chr(39), 'completion')})"),
    Layout("instruction", ("id", "input", "instruction", "output"), "id",
           f"array({_turn('0', chr(39) + 'user' + chr(39), "concat_ws(chr(10), instruction, nullif(input, ''))")}, {_turn('1', chr(39) + 'assistant' + chr(39), 'output')})"),
    Layout("messages", ("id", "messages[]", "messages[].content", "messages[].role"), "id", f"transform(messages, (m, i) -> {_turn('i', 'm.role', 'm.content')})"),
    Layout("from and value", ("conversations[]", "conversations[].from", "conversations[].value", "id"), "id",
           f"transform(conversations, (m, i) -> {_turn('i', 'CASE m.from WHEN ' + repr('human') + ' THEN ' + repr('user') + ' WHEN ' + repr('gpt') + ' THEN ' + repr('assistant') + ' ELSE m.from END', 'm.value')})"),
)


def _digest(paths) -> str:
    from hashlib import sha256

    return sha256("\n".join(sorted(paths)).encode()).hexdigest()


def field_paths(kind: T.DataType, at: str = "") -> list[str]:
    """Nested field paths of a schema; ``[]`` marks array elements."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{at}.{f.name}".lstrip("."))]
    if isinstance(kind, T.ArrayType):
        return [f"{at}[]", *(p for p in field_paths(kind.elementType, f"{at}[]") if p != f"{at}[]")]
    return [at]


def fitting_layouts(schema: T.StructType, layouts: tuple[Layout, ...] = LAYOUTS) -> list[Layout]:
    """The layouts whose fields the schema has, the one with most paths first; none raises ``ValueError``."""
    paths = set(field_paths(schema))
    fits = [x for x in layouts if x.fingerprint == _digest(paths & set(x.paths))]
    if not fits:
        raise ValueError(f"no layout has the fields {sorted(paths)}")
    return sorted(fits, key=lambda x: -len(x.paths))


def row_layout(fits: list[Layout]) -> Column:
    """The place in ``fits`` of the layout that a row's fingerprint selects.

    A row's fingerprint is the hash of the nested paths below its non-null fields. Each layout stands under the
    fingerprints of all choices of its text fields, since some may be null; the first of ``fits`` has one they share.
    A row with texts of several layouts goes to the first of these, the one of most paths: columns of the others
    are extra ones there. A row without any text goes to the first layout whose id it has.
    """
    below: dict[str, set[str]] = {}
    for x in fits:
        for p in x.paths:
            if (top := p.split(".")[0].removesuffix("[]")) in x.filled:
                below.setdefault(top, set()).add(p)
    prints: dict[str, int] = {}
    for i, x in enumerate(fits):
        for n in range(1, len(x.filled) + 1):
            for some in combinations(sorted(x.filled), n):
                prints.setdefault(_digest({p for top in some for p in below[top]}), i)
    none = F.array().cast("array<string>")
    held = F.flatten(F.array(*(F.when(F.col(top).isNotNull(), F.array(*map(F.lit, sorted(paths)))).otherwise(none) for top, paths in below.items())))
    table = F.create_map(*(F.lit(x) for pair in prints.items() for x in pair))
    kind = F.when(F.size(held) == 0, F.coalesce(*(F.when(F.col(x.conv_id).isNotNull(), i) for i, x in enumerate(fits)), F.lit(0)))
    found = F.try_element_at(table, F.sha2(F.array_join(F.array_sort(held), "\n"), 256))
    first = F.coalesce(*(F.when(reduce(or_, (F.col(top).isNotNull() for top in sorted(x.filled))), i) for i, x in enumerate(fits)))
    return kind.when(found.isNotNull(), found).otherwise(first)


def choose_layout(schema: T.StructType, layouts: tuple[Layout, ...] = LAYOUTS) -> Layout:
    """The layout whose fingerprint is that of the schema's own paths, columns of no layout set aside.

    Extra columns make no difference; if several layouts fit, the one with most paths wins, and equally long
    ones are told apart by their order in ``layouts``. A schema that fits none raises ``ValueError``.
    """
    return fitting_layouts(schema, layouts)[0]


def canonical_turns(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``(conv_id, turns)`` with turns ordered by number, then role, then text; null roles and texts become empty.

    Where the schema has the fields of several layouts, each row is read by the one that holds its non-null texts.
    A layout of one row per turn gathers each conversation's rows, repeated rows included; rows without an id
    form one conversation. A record without turns, such as an empty or null list, is a conversation of none.
    """
    fits = fitting_layouts(records.schema, layouts)
    turns = None
    for i, layout in enumerate(fits):
        rows = records.where(row_layout(fits) == i) if len(fits) > 1 else records
        part = rows.selectExpr(f"CAST({layout.conv_id} AS BIGINT) AS conv_id", f"coalesce({layout.turns}, array()) AS turns")
        if layout.rows:
            part = part.groupBy("conv_id").agg(F.flatten(F.collect_list("turns")).alias("turns"))
        turns = part if turns is None else turns.unionByName(part)
    filled = F.transform("turns", lambda t: F.struct(t["turn"].alias("turn"), F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text")))
    return turns.select("conv_id", F.array_sort(filled).alias("turns"))


def escape(text: Column) -> Column:
    """``text`` without control strings: a backslash breaks each, and backslashes double."""
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(F.regexp_replace(doubled, r"\[(/?)INST\]", r"[\\$1INST]"), r"</s>", r"<\\/s>")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_chat(turns: DataFrame, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``(conv_id, formatted, loss_spans)`` from ``(conv_id, turns)``.

    A turn reads ``[INST]role[/INST]text</s>`` with role and text escaped, so the string splits back into the same
    turns. ``loss_spans`` are the code-point ranges [start, end) of the texts whose role is learnt.
    """
    pieces = F.transform("turns", lambda t: F.struct(F.concat(F.lit(OPEN), escape(t["role"]), F.lit(CLOSE)).alias("head"), escape(t["text"]).alias("body"), t["role"].isin(*learn).alias("learn")))
    made = turns.select("conv_id", pieces.alias("pieces"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.expr("CAST(array() AS array<struct<start:bigint,end:bigint>>)").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        begin = acc["at"] + F.char_length(p["head"])
        end = begin + F.char_length(p["body"])
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct((end + len(END)).alias("at"), F.when(p["learn"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    text = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    return made.select("conv_id", text.alias("formatted"), F.aggregate("pieces", start, step)["spans"].alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted string holds."""
    pieces = F.slice(F.split(formatted, END), F.lit(1), F.greatest(F.size(F.split(formatted, END)) - 1, F.lit(0)))

    def turn(p: Column) -> Column:
        cut = F.instr(p, CLOSE)
        role = F.substr(p, F.lit(len(OPEN) + 1), cut - len(OPEN) - 1)
        return F.struct(unescape(role).alias("role"), unescape(F.substr(p, cut + len(CLOSE))).alias("text"))

    return F.transform(pieces, turn)


def op4_chat_format(spark, sf_dir: str) -> DataFrame:
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    trial = "</s>[INST] ok [/INST]"
    more = spark.sql(f"SELECT CAST(-1 AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, '{trial}' AS text FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)")
    out = format_chat(canonical_turns(given.select("conv_id", "turn", "role", "text").unionByName(more)))
    read = out.select(
        "conv_id", F.char_length("formatted").cast("long").alias("formatted_chars"), read_turns(F.col("formatted")).alias("turns"),
        unescape(F.array_join(F.transform("loss_spans", lambda s: F.substr("formatted", s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int"))), "")).alias("loss"),
    )
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(flat, 256).alias("turns_sha256"), F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


OP4_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
made AS (
  SELECT *, replace(regexp_replace(replace(role, '\', '\\'), '\[(/?)INST\]', '[\\\1INST]', 'g'), '</s>', '<\/s>') AS r,
            replace(regexp_replace(replace(text, '\', '\\'), '\[(/?)INST\]', '[\\\1INST]', 'g'), '</s>', '<\/s>') AS t FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(r) + length(t) + 17) AS BIGINT) AS formatted_chars
FROM made GROUP BY conv_id
"""
