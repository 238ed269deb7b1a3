"""Chat formatting from quotations: who answers whom, told by what they quote.

DataFrame expressions only. Lines are parsed into passages of one quote level
each. Normalised passages are hashed, and a quoted one is linked to the earliest
message that says it itself. The nearest level that finds a message gives the
parent; pointer jumping over parents gives roots and depths, and conversations
come out in reply order, without their quotes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillscope.llm.common import partitions, table, written

#: Leading quote signs of a line, with the white space between and behind them.
QUOTE = r"^(?:[ \t]*>)+[ \t]?"
#: A line that announces a quote and is dropped with it.
ATTRIBUTION = r"(?i)^[^\n]*\bwrote:[ \t]*$"
#: Turns that a message of the registered query quotes, each a level deeper.
QUOTED_TURNS = 3


# --- parsing -----------------------------------------------------------------------------

def parsed_lines(text: Column) -> Column:
    """Array of (level, content) of the lines of a text; one empty line for null."""
    lines = F.split(F.coalesce(text, F.lit("")), r"\r?\n")
    return F.transform(
        lines,
        lambda line: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(line, QUOTE, 0), "[^>]", "")).alias("level"),
            F.regexp_replace(line, QUOTE, "").alias("content"),
        ),
    )


def without_announcements(lines: Column) -> Column:
    """Parsed lines without those, of any level, that announce the deeper quote behind them."""
    ahead = lambda i: F.coalesce(F.get(lines, i + 1)["level"], F.lit(0))
    return F.filter(
        lines, lambda line, i: ~(line["content"].rlike(ATTRIBUTION) & (ahead(i) > line["level"]))
    )


def passages(rows: Column) -> Column:
    """Array of (level, text): runs of parsed lines of the same level."""
    level = lambda i: F.get(rows, i)["level"]
    starts = F.filter(
        F.transform(rows, lambda row, i: F.when((i == 0) | (level(i) != level(i - 1)), i)), lambda i: i.isNotNull()
    )
    stops = F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(F.size(rows)))
    return F.transform(
        F.zip_with(starts, stops, lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
        lambda run: F.struct(
            level(run["a"]).alias("level"),
            F.array_join(F.transform(F.slice(rows, run["a"] + 1, run["b"] - run["a"]), lambda r: r["content"]), "\n").alias("text"),
        ),
    )


def normal(text: Column) -> Column:
    """Lower case, each run of white space one space, none at the ends."""
    return F.btrim(F.regexp_replace(F.lower(text), r"\s+", " "))


def _units(texts: Column) -> Column:
    """(hash, size) of the normalised forms of an array of passages: each whole, its paragraphs and its lines.

    Hashed before they are dealt, so that no text moves to be linked.
    """
    paragraphs = F.flatten(F.transform(texts, lambda t: F.split(t, r"\n[ \t]*\n")))
    lines = F.flatten(F.transform(texts, lambda t: F.split(t, r"\n")))
    every = F.filter(F.transform(F.concat(texts, paragraphs, lines), normal), lambda t: t != "")
    # distinct as texts, which Spark does by hash; pairs it would compare one with another
    return F.transform(F.array_distinct(every), lambda t: F.struct(F.xxhash64(t).alias("hash"), F.length(t).alias("size")))


# --- linking -----------------------------------------------------------------------------

def linked_messages(messages: DataFrame) -> DataFrame:
    """message_id, parent_id, level, matched of every message with a quote that is found.

    ``messages``: message_id (of any type with an order), sent, own_parts, quoted. The
    original of a passage is the earliest message, by sent and message_id, that says it
    at level 0, whole, as a paragraph or as a line, so quotes that are trimmed to these are found;
    it has to be earlier than the quoting one. Of the nearest level that finds any, the
    parent is the message with the most characters found, then the earliest.
    """
    named = messages.filter("message_id is not null and sent is not null")
    own = named.select("message_id", "sent", F.inline(_units(F.col("own_parts"))))
    first = own.groupBy("hash", "size").agg(F.min(F.struct("sent", "message_id")).alias("origin"))
    quoted = named.select("message_id", "sent", F.explode("quoted").alias("q"))
    quoted = quoted.select("message_id", "sent", "q.level", F.inline(_units(F.array("q.text"))))
    met = quoted.distinct().join(first, ["hash", "size"])
    met = met.filter(F.col("origin") < F.struct("sent", "message_id"))
    votes = met.groupBy("message_id", "level", "origin").agg(F.sum("size").alias("matched"))
    best = votes.groupBy("message_id").agg(
        F.min(F.struct("level", (-F.col("matched")).alias("less"), "origin")).alias("best")
    )
    return best.select(
        "message_id", F.col("best.origin.message_id").alias("parent_id"),
        F.col("best.level").alias("level"), (-F.col("best.less")).alias("matched"),
    )


def roots(parents: DataFrame) -> DataFrame:
    """message_id, root, depth from message_id, parent_id, by pointer jumping.

    Each round doubles the way to the known ancestor; messages that have reached their
    root take no part in later ones. The side that is looked up has one row per message,
    so a root with very many descendants is a key that the skew join can split.
    """
    known = parents.select(
        "message_id", F.col("parent_id").alias("ancestor"), F.lit(1).cast("long").alias("depth"), F.lit(True).alias("open")
    )
    known = written(known, "quote-links")
    while not known.filter("open").isEmpty():
        inner = known.select(
            F.col("message_id").alias("of"), F.col("ancestor").alias("above"),
            F.col("depth").alias("more"), F.col("open").alias("further"),
        )
        moved = known.filter("open").join(inner, F.col("ancestor") == F.col("of"), "left").select(
            "message_id", F.coalesce("above", "ancestor").alias("ancestor"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.coalesce("further", F.lit(False)).alias("open"),
        )
        known = written(known.filter("not open").unionAll(moved), "quote-links")
    return known.select("message_id", F.col("ancestor").alias("root"), "depth")


def conversations(messages: DataFrame) -> DataFrame:
    """One row per row of ``messages`` (message_id, sent, role, text, others): message_id,
    conversation_id (its first message), parent_id, depth, place, role, text without quotes.

    ``place`` counts from 0 in reply order: by depth, then sent, then message_id, so
    every message comes after the one it answers. A message that quotes nothing known
    begins a conversation. Null texts are empty ones. Rows with a null message_id or
    sent quote nobody, are quoted by nobody and have a null conversation and place.
    Rows that repeat a message_id are parts of one message and each have a place. An
    empty table gives an empty result.
    """
    lines = messages.select("message_id", "sent", "role", parsed_lines(F.col("text")).alias("lines"))
    lines = lines.withColumn("kept", without_announcements(F.col("lines")))
    lines = lines.withColumn("runs", passages(F.col("kept")))
    own = F.transform(F.filter("runs", lambda r: r["level"] == 0), lambda r: r["text"])
    lines = lines.select(
        "message_id", "sent", "role", own.alias("own_parts"), F.filter("runs", lambda r: r["level"] > 0).alias("quoted"),
    )
    parts = written(
        lines.withColumn("said", F.btrim(F.array_join("own_parts", "\n"), F.lit(" \t\r\n"))), "quote-parts"
    )
    parents = written(linked_messages(parts), "quote-parents")
    placed = roots(parents.select("message_id", "parent_id"))
    known = parents.select("message_id", "parent_id").join(placed, "message_id")
    known = known.select(F.col("message_id").alias("of"), "parent_id", "root", "depth")
    rows = parts.select("message_id", "sent", "role", "said").join(known, F.col("message_id") == F.col("of"), "left")
    counted = F.col("message_id").isNotNull() & F.col("sent").isNotNull()
    rows = rows.select(
        "message_id", "sent", "role", F.col("said").alias("text"), "parent_id",
        F.when(counted, F.coalesce("root", "message_id")).alias("conversation_id"),
        F.when(counted, F.coalesce("depth", F.lit(0))).cast("long").alias("depth"),
    )
    return _in_reply_order(rows).select(
        "message_id", "conversation_id", "parent_id", "depth", F.when(counted, F.col("place")).alias("place"), "role", "text"
    )


def _in_reply_order(rows: DataFrame) -> DataFrame:
    """Adds ``place`` within the conversation, however large it is.

    Rows are dealt in the order of the result, so a conversation lies in consecutive
    parts: its place is its number in the part and what the parts before it hold.
    """
    order = ["conversation_id", "depth", "sent", "message_id"]
    dealt = rows.repartitionByRange(partitions(rows.sparkSession), *order)
    dealt = written(dealt.withColumn("part", F.spark_partition_id()), "quote-order")
    within = Window.partitionBy("conversation_id", "part").orderBy("depth", "sent", "message_id", "role", "text")
    dealt = dealt.withColumn("near", F.row_number().over(within) - 1)
    counts = dealt.groupBy("conversation_id", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conversation_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col("conversation_id").alias("c"), F.col("part").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("far")
    )
    same = F.col("conversation_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))
    return dealt.join(counts, same).withColumn("place", F.col("near") + F.col("far"))


# --- the registered query ---------------------------------------------------------------

def quoting_messages(turns: DataFrame, quoted: int = QUOTED_TURNS) -> DataFrame:
    """Mail-like messages from turns (conv_id, turn, role, text): each quotes the turns before
    it in its conversation, the one before at level 1, the one before that at level 2, ...

    Every quote is announced a level above it, and the deepest is trimmed to its first
    line. Turns are met by equality of conversation and number, so a long conversation
    is no group. message_id is the pair of conv_id and turn, null if either is; sent is the turn.
    """
    id_ = F.when(F.col("conv_id").isNotNull() & F.col("turn").isNotNull(), F.struct("conv_id", "turn"))
    text = turns.select(
        "conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"), id_.alias("message_id")
    )
    said = text.groupBy("conv_id", "turn").agg(F.min("text").alias("said"), F.min("role").alias("by"))
    result = text.withColumn("quotes", F.lit(""))
    for level in range(1, quoted + 1):
        words = F.split("said", "\n")[0] if level == quoted else F.col("said")
        earlier = said.select(
            F.col("conv_id").alias("c"), (F.col("turn") + level).alias("t"), words.alias("q"), F.col("by").alias("who")
        )
        result = result.join(earlier, (F.col("conv_id") == F.col("c")) & (F.col("turn") == F.col("t")), "left")
        sign, above = "\n" + ">" * level + " ", "\n\n" if level == 1 else "\n" + ">" * (level - 1) + " "
        announced = F.concat(F.lit(above + "The "), F.coalesce("who", F.lit("other")), F.lit(" wrote:"))
        added = F.concat(announced, F.lit(sign), F.replace(F.col("q"), F.lit("\n"), F.lit(sign)))
        result = result.withColumn("quotes", F.concat("quotes", F.coalesce(added, F.lit("")))).drop("c", "t", "q", "who")
    return result.select("message_id", F.col("turn").alias("sent"), "role", F.concat("text", "quotes").alias("text"))


def query(spark, sf_dir: str) -> DataFrame:
    """The pairs of ids as columns: conv_id and turn of the message, of its parent and of its conversation."""
    found = conversations(quoting_messages(table(spark, sf_dir, "conversations")))
    pairs = {"": "message_id", "parent_": "parent_id", "first_": "conversation_id"}
    return found.select(
        *[F.col(f"{c}.{part}").alias(prefix + part) for prefix, c in pairs.items() for part in ("conv_id", "turn")],
        "depth", "place", "role", "text",
    )


#: Without quotes: the parent is the earliest message that says what the turn before says,
#: whole, as a paragraph or as a line, and so on one level deeper where nothing is found.
#: Of the third turn before only the first line is quoted.
ORACLE = r"""
with recursive said as (
    select struct_pack(conv_id := conv_id, turn := turn) as message_id, conv_id, turn, role, coalesce(text, '') as text,
        trim(regexp_replace(lower(coalesce(text, '')), '\s+', ' ', 'g')) as plain
    from conversations
),
units as (
    select message_id, turn, plain as unit from said
    union
    select message_id, turn, trim(regexp_replace(lower(p), '\s+', ' ', 'g'))
    from (select message_id, turn, unnest(regexp_split_to_array(text, '\n[ \t]*\n')) as p from said)
    union
    select message_id, turn, trim(regexp_replace(lower(p), '\s+', ' ', 'g'))
    from (select message_id, turn, unnest(string_split(text, chr(10))) as p from said)
),
origin as (
    select unit, min(struct_pack(sent := turn, message_id := message_id)) as origin
    from units where unit <> '' group by unit
),
quoted as (
    select message_id, 1 as level, unit from units union all select message_id, 2, unit from units
    union all
    select message_id, 3, trim(regexp_replace(lower(string_split(text, chr(10))[1]), '\s+', ' ', 'g')) from said
),
asked as (
    select distinct a.message_id, a.turn, u.level, u.unit
    from said a join said b on b.conv_id = a.conv_id and b.turn between a.turn - 3 and a.turn - 1
    join quoted u on u.message_id = b.message_id and u.level = a.turn - b.turn
    where u.unit <> ''
),
votes as (
    select a.message_id, level, o.origin, sum(length(unit)) as matched
    from asked a join origin o using (unit)
    where o.origin < struct_pack(sent := a.turn, message_id := a.message_id)
    group by all
),
parents as (
    select message_id, origin.message_id as parent_id
    from votes
    qualify row_number() over (partition by message_id order by level, matched desc, origin) = 1
),
tree as (
    select message_id, message_id as conversation_id,
           cast(null as struct(conv_id bigint, turn bigint)) as parent_id, 0 as depth
    from said where message_id not in (select message_id from parents)
    union all
    select p.message_id, t.conversation_id, p.parent_id, t.depth + 1
    from parents p join tree t on t.message_id = p.parent_id
)
select s.conv_id, s.turn, t.parent_id.conv_id as parent_conv_id, t.parent_id.turn as parent_turn,
    t.conversation_id.conv_id as first_conv_id, t.conversation_id.turn as first_turn, cast(t.depth as bigint) as depth,
    row_number() over (partition by t.conversation_id order by t.depth, s.turn, s.message_id) - 1 as place,
    s.role, trim(s.text, ' ' || chr(9) || chr(10) || chr(13)) as text
from said s join tree t using (message_id)
"""
