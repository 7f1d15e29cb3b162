"""Quotation linking: nested quotes are parsed, hashed and joined to the messages they come from; replies are put in order.

A line's quote level is its number of leading ``>`` marks. Consecutive lines of one level, up to a blank line or
an introduction ("On ..., X wrote:"), are a passage. Passages of level 0 are a message's own; all others are quoted. A quoted
passage comes from the earliest message of its scope whose own passage has the same digest, after lower-casing and
with white space collapsed, if that message is earlier than the quoting one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usertide.llm._shared import stored, whole_text, work_folder

MARKS = r"^(?:[ \t]*>)+"
#: How mail programs introduce a quotation.
WROTE = r"(?i)^.*\b(?:wrote|schrieb|a écrit|escribió)\b.*:[ \t]*$"
_PASSAGES = "array<struct<level:int,text:string>>"


def passages_of(text: Column) -> Column:
    """The passages of a text, in order, as ``array<struct<level, text>>``, without marks, introductions and blank ones."""
    lines = F.split(F.translate(text, "\x1e\x1f\r", "  "), "\n")
    parts = F.transform(
        lines,
        lambda x: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 0), "[^>]", "")).alias("level"),
            F.regexp_replace(x, MARKS + r"[ \t]?", "").alias("text"),
        ),
    )

    def tag(part: Column, i: Column, parts: Column) -> Column:
        intro = (F.coalesce(F.get(parts, i + 1)["level"], F.lit(0)) > part["level"]) & part["text"].rlike(WROTE)
        blank = intro | (F.trim(part["text"]) == "")
        follows = (i > 0) & (F.get(parts, i - 1)["level"] == part["level"]) & ~blank
        start = F.concat(F.lit("\x1e"), part["level"].cast("string"), F.lit("\x1f"))
        return F.concat(F.when(follows, "\n").otherwise(start), F.when(blank, "").otherwise(part["text"]))

    # one pass over the lines puts a mark before each passage; the marks then cut the joined text
    tagged = F.transform(F.array(parts), lambda p: F.array_join(F.transform(p, lambda x, i: tag(x, i, p)), ""))[0]
    cut = F.transform(
        F.split(tagged, "\x1e"),
        lambda p: F.struct(
            F.coalesce(F.substring_index(p, "\x1f", 1).try_cast("int"), F.lit(0)).alias("level"),
            F.trim(F.regexp_replace(F.substring_index(p, "\x1f", -1), "^\n+|\n+$", "")).alias("text"),
        ),
    )
    return F.filter(cut, lambda p: p["text"] != "").cast(_PASSAGES)


def digest_of(passage: Column) -> Column:
    return F.unhex(F.sha2(F.trim(F.regexp_replace(F.lower(passage), r"\s+", " ")), 256))


def link_quotes(
    messages: DataFrame,
    scope: str = "conv_id",
    position: str = "turn",
    text_col: str = "text",
    work: str | None = None,
) -> DataFrame:
    """Per message, in reply order: ``scope, position, text_hash, own, quoted, linked, sources, parent, thread, depth``.

    ``own`` is the message without quotes; ``quoted`` and ``linked`` count its quoted passages and those that were found;
    ``sources`` are the positions they come from. ``parent`` is the message that most passages of level 1 come from, the
    latest one if several do; ``thread`` is the position that parents lead to in the end, ``depth`` how many steps that takes.
    Rows are sorted by scope, thread and position, which puts every reply after what it replies to.

    NULL counts as an empty text, and an empty message quotes nothing. A message without scope or position is not
    linked. Rows that repeat scope and position are one message for links, whose parent is the smallest one found; each keeps
    its own row. An empty table gives an empty result. Other columns are ignored, whatever their names.
    """
    work = work_folder(messages.sparkSession, work)
    text = whole_text(text_col)
    rows = messages.select(F.col(scope).alias("scope"), F.col(position).alias("at"), text.alias("t"))
    rows = rows.select("scope", "at", F.xxhash64("t").alias("text_hash"), passages_of(F.col("t")).alias("found"))
    own = F.transform(F.filter("found", lambda p: p["level"] == 0), lambda p: p["text"])
    said = F.transform("found", lambda p: F.struct(p["level"].alias("level"), digest_of(p["text"]).alias("digest")))
    rows = rows.select("scope", "at", "text_hash", F.array_join(own, "\n\n").alias("own"), said.alias("said"))
    rows = stored(rows, f"{work}/messages")  # parsed once; of what is quoted only digests
    each = rows.where("scope is not null and at is not null").select("scope", "at", "text_hash", F.posexplode("said").alias("k", "p"))
    each = each.select("scope", "at", "text_hash", "k", "p.level", "p.digest")
    # a passage that very many messages share is one row here, and a join splits those who quote it
    first = each.where("level = 0").groupBy("scope", "digest").agg(F.min("at").alias("source"))
    first = stored(first, f"{work}/first")
    links = each.where("level > 0").join(first, ["scope", "digest"]).where("source < at")
    links = stored(links.select("scope", "at", "text_hash", "k", "level", "source").distinct(), f"{work}/links")
    votes = links.where("level = 1").groupBy("scope", "at", "source").agg(F.countDistinct("text_hash", "k").alias("n"))
    parents = votes.groupBy("scope", "at").agg(F.max(F.struct("n", "source"))["source"].alias("parent"))
    nodes = stored(thread_roots(stored(parents, f"{work}/parents"), work), f"{work}/threads")
    found = links.groupBy("scope", "at", "text_hash").agg(
        F.countDistinct("k").alias("linked"), F.sort_array(F.collect_set("source")).alias("sources")
    )
    found = found.select(*[F.col(c).alias(f"__{c}") for c in ("scope", "at", "text_hash")], "linked", "sources")
    nodes = nodes.select(F.col("scope").alias("__s"), F.col("at").alias("__a"), "parent", "root", "depth")
    quoted = F.size(F.filter("said", lambda p: p["level"] > 0))
    out = rows.select("scope", "at", "text_hash", "own", quoted.alias("quoted"))
    same = (F.col("scope") == F.col("__scope")) & (F.col("at") == F.col("__at")) & (F.col("text_hash") == F.col("__text_hash"))
    out = out.join(found, same, "left").join(nodes, (F.col("scope") == F.col("__s")) & (F.col("at") == F.col("__a")), "left")
    thread = F.coalesce("root", "at")
    return out.select(
        F.col("scope").alias(scope),
        F.col("at").alias(position),
        "text_hash",
        "own",
        F.col("quoted").cast("long").alias("quoted"),
        F.coalesce("linked", F.lit(0)).cast("long").alias("linked"),
        F.coalesce("sources", F.array().cast(found.schema["sources"].dataType)).alias("sources"),
        "parent",
        thread.alias("thread"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
    ).orderBy(scope, "thread", position)


def thread_roots(parents: DataFrame, work: str, rounds: int = 64) -> DataFrame:
    """Where parents lead in the end (``root``), and in how many steps (``depth``): each round doubles the steps taken.

    Parents come before their messages, so there is no cycle. A message without a parent is a root and has no row. Messages
    that have arrived at their root take no part in later rounds, so these are as large as long threads are many.
    """
    now = parents.select("scope", "at", "parent", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth"))
    now, arrived = stored(now, f"{work}/jump-0"), []
    for k in range(1, rounds + 1):
        known = reduce(DataFrame.unionByName, arrived, now)
        up = known.select(F.col("scope").alias("s"), F.col("at").alias("a"), F.col("root").alias("next"), F.col("depth").alias("more"))
        far = now.join(up, (now["scope"] == up["s"]) & (now["root"] == up["a"]), "left").select(
            "scope",
            "at",
            "parent",
            F.coalesce("next", "root").alias("root"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.col("next").isNotNull().alias("moved"),
        )
        far = stored(far, f"{work}/jump-{k}")
        arrived.append(far.where("not moved").drop("moved"))
        now = far.where("moved").drop("moved")
        if now.isEmpty():
            return reduce(DataFrame.unionByName, arrived)
    raise RuntimeError(f"threads did not settle in {rounds} rounds")


def quoted_mail(conversations: DataFrame) -> DataFrame:
    """Conversations as mail that quotes: ``conv_id, turn, role, text``.

    A turn answers the one before it, every third the one before that. Its text is followed by the answered message, with
    the message which that one answers quoted within it. Of repeated turns, the smallest text is quoted.
    """
    answers = F.when(F.col("turn") % 3 == 2, F.col("turn") - 2).otherwise(F.col("turn") - 1)
    said = conversations.select("conv_id", "turn", "role", "text", answers.alias("to"))
    quoted = said.groupBy("conv_id", "turn").agg(F.min(F.struct("role", "text", "to")).alias("m"))

    def marked(text: Column, marks: str) -> Column:
        return F.concat(F.lit(marks), F.regexp_replace(F.coalesce(text, F.lit("")), "\n", "\n" + marks))

    def told(role: Column, turn: Column, marks: str) -> Column:
        return F.concat(F.lit("\n" + marks + "On turn "), turn.cast("string"), F.lit(" the "), F.coalesce(role, F.lit("?")), F.lit(" wrote:\n"))

    one = quoted.select(F.col("conv_id").alias("c1"), F.col("turn").alias("t1"), F.col("m").alias("m1"))
    two = quoted.select(F.col("conv_id").alias("c2"), F.col("turn").alias("t2"), F.col("m").alias("m2"))
    # first what a message answers: a first turn then asks for a turn that is not there, not for NULL
    one = one.join(two, (F.col("c1") == F.col("c2")) & (F.col("m1.to") == F.col("t2")), "left")
    both = said.join(one, (said["conv_id"] == F.col("c1")) & (said["to"] == F.col("t1")), "left")
    outer = F.concat(F.lit("\n"), told(F.col("m1.role"), F.col("t1"), ""), marked(F.col("m1.text"), "> "))
    inner = F.concat(told(F.col("m2.role"), F.col("t2"), "> "), marked(F.col("m2.text"), ">> "))
    text = F.concat(F.coalesce("text", F.lit("")), F.coalesce(outer, F.lit("")), F.coalesce(inner, F.lit("")))
    return both.select("conv_id", "turn", "role", text.alias("text"))
