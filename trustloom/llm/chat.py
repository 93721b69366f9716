r"""Chat formatting with a grammar round trip (native).

Grammar of the formatted text: ``conversation := turn*`` and
``turn := "<|im_start|>" role "\n" content "<|im_end|>\n"``, where neither role nor content holds
``<|``. The deterministic parser cuts at ``<|im_end|>``, reads the role up to the first line feed and
takes one backslash out of each ``<\...\|``. A turn is first written as it is, reparsed on its own and
compared with its source; a turn that does not come back is written with its conflicting places
escaped (one backslash more between ``<`` and ``|``), which the parser undoes. The whole conversation
is then reparsed and compared as well; the verdict is the column ``round_trip``.

Defined cases: a null text or role is empty, a null turn number comes first, equal turn numbers are
ordered by role and text, repeated rows stay repeated turns, a null conversation id forms one
conversation of its own, an empty table gives no conversation; texts of any length are kept whole; other
columns are ignored, whatever their names. A conversation is one training record
and therefore one row; the rows of a conversation, and nothing larger, meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustloom.functions.stats import let

START, END = "<|im_start|>", "<|im_end|>"
#: A control string, or an escaped one: "<", backslashes, "|".
CONFLICT = r"<(\\*)\|"
ESCAPED = r"<\\(\\*)\|"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONFLICT, r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, r"<$1|")


def _escape_role(role: Column) -> Column:
    """A role is one line: line feeds become ``<n`` and a ``<n`` of its own gets a backslash."""
    return F.replace(F.regexp_replace(escape(role), r"<(\\*)n", r"<\\$1n"), F.lit("\n"), F.lit("<n"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.regexp_replace(F.regexp_replace(role, r"<n", "\n"), r"<\\(\\*)n", r"<$1n"))


def _frame(role: Column, content: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), content, F.lit(END + "\n"))


def parse_turns(formatted: Column) -> Column:
    """The deterministic parser: array of (role, text, raw), with null fields where the grammar is broken."""

    def read(b: Column) -> Column:
        def parts(inner: Column) -> Column:
            at = F.instr(inner, "\n")
            sound = (at > 0) & ~F.contains(inner, F.lit("<|"))
            raw = F.when(sound, F.substr(inner, at + 1))
            return F.struct(F.when(sound, _unescape_role(F.substr(inner, F.lit(1), at - 1))).alias("role"), unescape(raw).alias("text"), raw.alias("raw"))

        return let(F.when(b.startswith(START), F.substr(b, F.lit(len(START) + 1))), parts)

    def turns(blocks: Column) -> Column:
        body = F.transform(F.slice(blocks, F.lit(1), F.size(blocks) - 1), lambda b, i: F.when(i == 0, b).when(b.startswith("\n"), F.substr(b, F.lit(2))))
        return F.transform(body, read)

    # bound once: the text is cut once, and not for every block of it
    return let(F.split(formatted, r"<\|im_end\|>", -1), turns)


def format_turn(role: Column, text: Column) -> Column:
    """One turn, escaped only if its plain form does not come back from the parser as itself alone."""
    plain = _frame(role, text)
    whole = let(parse_turns(plain), lambda back: (F.size(back) == 1) & back[0]["role"].eqNullSafe(role) & back[0]["text"].eqNullSafe(text))
    return F.when(whole, plain).otherwise(_frame(_escape_role(role), escape(text)))


def format_chats(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: formatted text, loss spans and the parsed turns.

    ``loss_spans`` has a (turn, start, length) for each assistant text, in characters of the formatted
    text. One shuffle, by conversation.
    """
    turns = rows.select(
        F.col(id_col).alias(id_col),
        F.col(turn_col).cast("long").alias("n"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).withColumn("f", format_turn(F.col("role"), F.col("text")))
    chats = turns.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("n", "role", "text", "f"))).alias("t0"))
    # array_sort puts null turn numbers first, as every struct field compares with nulls lowest
    chats = chats.withColumn("formatted", F.array_join(F.transform("t0", lambda t: t["f"]), ""))
    chats = chats.withColumn("turns", parse_turns(F.col("formatted")))
    same = F.transform("t0", lambda t: F.concat(t["role"], F.lit("\n"), t["text"])) == F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"])
    )
    chats = chats.withColumn("round_trip", F.coalesce(same, F.lit(False)))
    sizes = F.transform(
        "turns",
        lambda t: F.struct(F.length(_frame(_escape_role_if(t["role"]), F.lit(""))).alias("head"), F.length(t["raw"]).alias("body"), (t["role"] == "assistant").alias("on")),
    )
    chats = chats.withColumn("_s", sizes)

    def located(starts: Column) -> Column:
        each = F.transform(
            "_s",
            lambda s, i: F.when(s["on"], F.struct(i.alias("turn"), (F.element_at(starts, i + 1) + s["head"] - len(END) - 1).alias("start"), s["body"].alias("length"))),
        )
        return F.filter(each, lambda x: x.isNotNull())

    spans = let(sums_before(F.transform("_s", lambda s: s["head"] + s["body"])), located)
    return chats.withColumn("loss_spans", spans).select(id_col, "formatted", "turns", "loss_spans", "round_trip")


#: Elements that are summed up one by one; blocks of them are summed up as a whole first.
SUM_BLOCK = 512


def sums_before(values: Column) -> Column:
    """For each of an array of ints, the sum of those before it. In two levels, as growing one array by one
    element at a time would cost the square of its length."""
    add = lambda a, x: a + x
    starts = F.sequence(F.lit(0), F.greatest(F.size(values) - 1, F.lit(0)), F.lit(SUM_BLOCK))

    def inside(block: Column, before: Column) -> Column:
        zero = F.struct(before.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(block, zero, lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    def over(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), add))
        return let(totals, lambda t: F.flatten(F.transform(blocks, lambda b, i: inside(b, F.aggregate(F.slice(t, F.lit(1), i), F.lit(0), add)))))

    return let(values, lambda v: let(F.transform(starts, lambda k: F.slice(v, k + 1, F.lit(SUM_BLOCK))), over))


def _escape_role_if(role: Column) -> Column:
    return F.when(role.rlike(r"\n|<\\*[|n]"), _escape_role(role)).otherwise(role)


def read_back(chats: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Digests of what the parser and the loss mask give back from the formatted text."""
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    # the spans are cut turn by turn: a cut at a character offset costs the way to it
    framed = F.split("formatted", r"(?<=<\|im_end\|>\n)", -1)

    def under_mask(frames: Column) -> Column:
        def cut(at: Column) -> Column:
            return F.transform("loss_spans", lambda s: unescape(F.substr(F.element_at(frames, s["turn"] + 1), s["start"] - F.element_at(at, s["turn"] + 1) + 1, s["length"])))

        return let(sums_before(F.transform(frames, F.length)), cut)

    out = chats.withColumn("_m", F.array_join(let(framed, under_mask), ""))
    return out.select(
        id_col,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(text, 256).alias("turns_sha256"),
        F.length("_m").cast("long").alias("loss_chars"),
        F.sha2(F.col("_m"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "round_trip",
    )
