"""Chat formatting: typed content parts flattened into one template, with a loss mask.

Only DataFrame functions are used. A conversation's rows are first grouped by runs of turns, so that
one very long conversation is built from bounded pieces formatted in many tasks; the pieces carry
text and offsets of their own and are only concatenated at the end.

Defined results: null text, a null part or one of an unknown kind is empty text; an attachment of unknown
size stands for 0 tokens; null role is the empty role; rows are ordered by
turn (null first), ties by role, then parts; null conv_id is a conversation of its own; repeated rows
are turns of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
PIECE = 256

#: Whatever could be taken for a control string gets one more backslash after its first character.
_CONTROL = r"(/?s>|/?INST\]|\|)"
_ESCAPE, _UNESCAPE = rf"([<\[])(\\*){_CONTROL}", rf"([<\[])\\(\\*){_CONTROL}"

#: One content part.
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, _ESCAPE, r"$1\\$2$3")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, _UNESCAPE, r"$1$2$3")


def text_parts(text: Column) -> Column:
    """A plain text as a list of one part."""
    part = F.struct(
        F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("width"),
        F.lit(None).cast("int").alias("height"), F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"),
    )
    return F.array(part)


_FILES = ("image", "audio", "document")


def _body(parts: Column) -> Column:
    """The text that the parts of a turn leave in it. Neighbouring texts are one text before they are escaped,
    so that no control string forms where they meet; parts of unknown kinds leave nothing."""
    run = lambda file, text: F.struct(file.alias("file"), text.alias("text"))
    none = F.array().cast("array<struct<file:string,text:string>>")

    def visit(runs: Column, p: Column) -> Column:
        text = F.when(p["type"] == "text", F.coalesce(p["text"], F.lit(""))).otherwise(F.lit(""))
        last = F.try_element_at(runs, F.lit(-1))
        longer = F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(run(F.lit(None).cast("string"), F.concat(last["text"], text))))
        return F.when(p["type"].isin(*_FILES), F.concat(runs, F.array(run(p["type"], F.lit(""))))).when((F.size(runs) > 0) & last["file"].isNull(), longer).otherwise(F.concat(runs, F.array(run(F.lit(None).cast("string"), text))))

    said = F.transform(F.aggregate(parts, none, visit), lambda r: F.when(r["file"].isNotNull(), F.concat(F.lit("<|"), r["file"], F.lit("|>"))).otherwise(escape(r["text"])))
    alone = (F.size(parts) == 1) & (F.try_element_at(parts, F.lit(1))["type"] == "text")
    return F.when(alone, escape(F.coalesce(F.try_element_at(parts, F.lit(1))["text"], F.lit("")))).otherwise(F.array_join(said, ""))


def _tokens(p: Column, patch: int, rate: float, per_page: int) -> Column:
    """Tokens that stand for an attachment in the expanded sequence; 0 where its size is unknown."""
    tiles = F.ceil(p["width"] / patch) * F.ceil(p["height"] / patch)
    n = F.when(p["type"] == "image", tiles).when(p["type"] == "audio", F.ceil(p["seconds"] * rate)).when(p["type"] == "document", p["pages"].cast("long") * per_page)
    return F.coalesce(n.cast("long"), F.lit(0).cast("long"))


def format_pieces(df: DataFrame, parts: Column | None = None, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", learn: tuple[str, ...] = ("assistant",), patch: int = 14, rate: float = 25.0, per_page: int = 1024) -> DataFrame:
    """Rows (conv_id, piece, formatted, loss_spans, attachments, n_turns): runs of up to about PIECE
    turns of a conversation. ``parts`` is an array of PART; without it column ``text`` is used.
    loss_spans are [start, end) in code points of this piece; the k-th placeholder in the text is
    the k-th of attachments (kind, ref, n_tokens)."""
    parts = text_parts(F.col("text")) if parts is None else F.coalesce(parts, F.array().cast(f"array<{PART}>"))
    rows = df.select(F.col(conv).alias("conv_id"), F.floor(F.col(turn) / PIECE).alias("piece"), F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), parts.alias("parts")).alias("t"))
    rows = rows.groupBy("conv_id", "piece").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    made = F.transform("turns", lambda t: F.struct(F.concat(F.lit(TURN), escape(t["role"]), F.lit(BODY)).alias("head"), _body(t["parts"]).alias("body"), t["role"].isin(*learn).alias("learn")))
    files = F.flatten(F.transform("turns", lambda t: F.filter(t["parts"], lambda p: p["type"].isin(*_FILES))))
    rows = rows.select("conv_id", "piece", made.alias("made"), F.transform(files, lambda p: F.struct(p["type"].alias("kind"), p["ref"].alias("ref"), _tokens(p, patch, rate, per_page).alias("n_tokens"))).alias("attachments"))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        start = acc["at"] + F.length(t["head"])
        end = start + F.length(t["body"])
        mine = F.when(t["learn"], F.array(F.struct(start.alias("start"), end.alias("end")))).otherwise(F.array().cast("array<struct<start:int,end:int>>"))
        return F.struct((end + len(END)).alias("at"), F.concat(acc["spans"], mine).alias("spans"))

    return rows.select(
        "conv_id", "piece", F.array_join(F.transform("made", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("formatted"),
        F.aggregate("made", empty, step)["spans"].alias("loss_spans"), "attachments", F.size("made").cast("long").alias("n_turns"),
    )


def format_chat(df: DataFrame, parts: Column | None = None, **options) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans, attachments, n_turns, n_expanded
    (tokens that the placeholders stand for)."""
    p = format_pieces(df, parts, **options)
    g = p.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("piece", "formatted", "loss_spans", "attachments"))).alias("p"), F.sum("n_turns").alias("n_turns"))
    whole = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    shift = lambda acc, x: F.struct(
        (acc["at"] + F.length(x["formatted"])).alias("at"),
        F.concat(acc["spans"], F.transform(x["loss_spans"], lambda s: F.struct((s["start"] + acc["at"]).alias("start"), (s["end"] + acc["at"]).alias("end")))).alias("spans"),
    )
    files = F.flatten(F.col("p.attachments"))
    return g.select(
        "conv_id", F.array_join("p.formatted", "").alias("formatted"), F.aggregate("p", whole, shift)["spans"].alias("loss_spans"), files.alias("attachments"), "n_turns",
        F.aggregate(files, F.lit(0).cast("long"), lambda a, f: a + f["n_tokens"]).alias("n_expanded"),
    )


def parse(formatted: Column) -> Column:
    """Turns (role, text) read back from formatted text; placeholders stay as they are."""
    pieces = F.slice(F.split(formatted, r"<\|turn\|>"), 2, 1 << 30)

    def one(x: Column) -> Column:
        head = F.substring_index(x, BODY, 1)
        body = F.substr(x, F.length(head) + len(BODY) + 1, F.length(x) - F.length(head) - len(BODY) - len(END))
        return F.struct(unescape(head).alias("role"), unescape(body).alias("text"))

    return F.transform(pieces, one)


def masked(formatted: Column, spans: Column) -> Column:
    """Texts under the loss mask, unescaped, in order."""
    return F.transform(spans, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["end"] - s["start"])))


def digests(pieces: DataFrame) -> DataFrame:
    """Read ``format_pieces`` back: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    p = pieces.select(
        "conv_id", "piece", F.size(parse(F.col("formatted"))).cast("long").alias("n"), F.length("formatted").cast("long").alias("chars"),
        F.array_join(F.transform(parse(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
        F.array_join(masked(F.col("formatted"), F.col("loss_spans")), "").alias("loss"),
    )
    g = p.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sort_array(F.collect_list(F.struct("piece", "turns", "loss"))).alias("p"), F.sum("chars").alias("formatted_chars"))
    loss = F.array_join("p.loss", "")
    return g.select("conv_id", "n_turns", F.sha2(F.array_join("p.turns", ""), 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")


def query(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    own = spark.sql("SELECT bigint(-7) AS conv_id, bigint(t) AS turn, r AS role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0, 'user'), (1, 'assistant') AS v(t, r)")
    return digests(format_pieces(rows.unionByName(own)))


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length(regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\]|\|)', '\1\\\2\3', 'g'))
          + length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\]|\|)', '\1\\\2\3', 'g')) + 23 AS chars FROM c
), g AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
         CAST(sum(chars) AS BIGINT) AS formatted_chars
  FROM e GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g
"""
