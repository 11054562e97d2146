r"""Chat formatting of messages made of typed content parts.

A message has a role and an ordered list of parts. The visitor turns each part
into a piece: text is escaped; an image, audio or document part becomes the
placeholder ``<|kind|>`` of its kind, its reference and expanded token count are
recorded, so the k-th placeholder of a conversation is its k-th attachment. A turn
is ``### role: pieces</turn>`` and a line break.

Escaping is reversible: a backslash is doubled, and a backslash is put inside
``</turn>``, ``<|`` and ``##``, so none of the template's strings occurs
in an escaped text. Undoing it drops every backslash that begins a pair. Text parts that follow one another are
joined before they are escaped, so no such string forms where they meet. In roles
``%`` and ``:`` are written as ``%25`` and ``%3A`` first.

The loss mask is a list of spans (turn, start, length): code points of the
turn's block, which ends before ``</turn>``. It covers the text pieces of the
roles that are trained on, and no placeholder. Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, MIDDLE, END = "### ", ": ", "</turn>\n"
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"

# Tokens that an attachment stands for: an image per patch of 28 x 28, audio per
# 40 ms, a document per page.
PATCH, AUDIO_RATE, PAGE_TOKENS = 28, 25, 512


def escape(text: Column) -> Column:
    for old, new in (("\\", "\\\\"), ("</turn>", "<\\/turn>"), ("<|", "<\\|"), ("##", "#\\#")):
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit(":"), F.lit("%3A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%3A"), F.lit(":")), F.lit("%25"), F.lit("%"))


def text_part(text: Column) -> Column:
    """The parts of a message that is text alone."""
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"))).cast(
        "array<struct<kind:string,text:string>>")


def full_part(part: Column, fields: list[str]) -> Column:
    """A part with all fields of ``PART``; those it lacks are null."""
    kinds = {x.split(":")[0]: x.split(":")[1] for x in PART[7:-1].split(",")}
    return F.struct(*[(part[k] if k in fields else F.lit(None)).cast(t).alias(k) for k, t in kinds.items()])


def _is_text(p: Column) -> Column:
    return F.coalesce(p["kind"], F.lit("text")) == "text"


def visit(p: Column) -> Column:
    """The raw piece of a part: its text, or the kind of its placeholder."""
    return F.struct(F.when(_is_text(p), F.coalesce(p["text"], F.lit(""))).otherwise(F.coalesce(p["kind"], F.lit(""))).alias("s"),
                    _is_text(p).alias("is_text"))


def pieces(parts: Column) -> Column:
    """The pieces of a turn: escaped texts, adjoining ones as one, and placeholders."""
    def add(done: Column, part: Column) -> Column:
        p, last = visit(part), F.try_element_at(done, F.lit(-1))  # null before the first piece
        joined = F.struct(F.concat(last["s"], p["s"]).alias("s"), F.lit(True).alias("is_text"))
        return F.when(F.coalesce(last["is_text"], F.lit(False)) & p["is_text"],
                      F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(joined))).otherwise(F.concat(done, F.array(p)))

    raw = F.aggregate(parts, F.array().cast("array<struct<s:string,is_text:boolean>>"), add)
    return F.transform(raw, lambda p: F.struct(
        F.when(p["is_text"], escape(p["s"])).otherwise(F.concat(F.lit("<|"), escape(p["s"]), F.lit("|>"))).alias("s"), p["is_text"].alias("is_text")))


def expanded_tokens(p: Column) -> Column:
    """Tokens an attachment stands for; 1 for an unknown kind or unknown size."""
    image = F.ceil(p["width"] / PATCH) * F.ceil(p["height"] / PATCH)
    n = (F.when(p["kind"] == "image", image).when(p["kind"] == "audio", F.ceil(p["seconds"] * AUDIO_RATE))
         .when(p["kind"] == "document", p["pages"].cast("long") * PAGE_TOKENS))
    return F.greatest(F.coalesce(n, F.lit(1).cast("long")), F.lit(1).cast("long"))


def format_turns(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 parts_col: str = "parts", loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per message, no shuffle: ``conv, turn, role, block, spans, attachments``.

    The parts of ``format_messages`` before conversations are put together: a conversation of any length stays
    rows here. ``spans``: start and length of the text under the loss mask in ``block``."""
    fields = messages.schema[parts_col].dataType.elementType.names
    m = messages.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"),
        F.transform(F.coalesce(parts_col, F.array().cast(messages.schema[parts_col].dataType)),
                    lambda p: full_part(p, fields)).alias("parts"))
    m = m.withColumns({"head": F.concat(F.lit(HEAD), escape_role(F.col("role")), F.lit(MIDDLE)), "pieces": pieces(F.col("parts"))})
    # where each text piece stands in its block
    start = F.struct(F.length("head").alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    spans = F.aggregate("pieces", start, lambda a, p: F.struct(
        (a["at"] + F.length(p["s"])).alias("at"),
        F.when(p["is_text"], F.concat(a["spans"], F.array(F.struct(a["at"].alias("start"), F.length(p["s"]).alias("length")))))
        .otherwise(a["spans"]).alias("spans")), lambda a: a["spans"])
    attachments = F.transform(F.filter("parts", lambda p: ~_is_text(p)), lambda p: F.struct(
        p["kind"].alias("kind"), p["ref"].alias("ref"), expanded_tokens(p).alias("tokens")))
    return m.select(
        "conv", "turn", "role", F.concat(F.col("head"), F.array_join(F.transform("pieces", lambda p: p["s"]), "")).alias("block"),
        F.when(F.col("role").isin(*loss_roles), spans).otherwise(F.array().cast("array<struct<start:int,length:int>>")).alias("spans"),
        attachments.alias("attachments"))


def format_messages(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                    parts_col: str = "parts", loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: ``conv_col, n_turns, formatted, loss_spans, attachments, attachment_tokens``.

    ``messages``: a row per turn; ``parts`` is an array of structs with some or
    all fields of ``PART``. Turns are ordered by ``turn``, ties by role, then by
    content; repeated rows are turns each. Defined results: a null role or text is
    empty, a null or empty part list is an empty text, a null kind is text, an
    unknown kind is an attachment of its name; rows with a null ``conv_col`` make one
    conversation; other columns are not read; no rows in, no rows out.

    A conversation is one value of the result, and Spark holds at most 2 GB in a value: beyond that the job fails; use
    ``format_turns`` there.
    """
    # formatted per turn before the shuffle; a conversation is one row of the result
    turn = F.struct("turn", "role", "block", "spans", "attachments")
    conv = format_turns(messages, conv_col, turn_col, role_col, parts_col, loss_roles).select("conv", turn.alias("t")).groupBy(
        "conv").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    spans = F.flatten(F.transform("turns", lambda t, i: F.transform(
        t["spans"], lambda s: F.struct(i.alias("turn"), s["start"].alias("start"), s["length"].alias("length")))))
    return conv.select(
        F.col("conv").alias(conv_col), F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["block"], F.lit(END))), "").alias("formatted"),
        spans.alias("loss_spans"), F.flatten(F.transform("turns", lambda t: t["attachments"])).alias("attachments"),
    ).withColumn("attachment_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]))


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds ``blocks`` (the turns' blocks), ``turns`` (role, text) and ``loss_texts``, read from the formatted text alone."""
    blocks = F.split("formatted", END)
    f = formatted.withColumn("blocks", F.slice(blocks, F.lit(1), F.size(blocks) - 1))
    role = lambda b: F.substring_index(b, ":", 1)
    turns = F.transform("blocks", lambda b: F.struct(
        unescape_role(F.substring(role(b), F.lit(len(HEAD) + 1), F.length(b))).alias("role"),
        unescape(F.substring(b, F.length(role(b)) + 1 + len(MIDDLE), F.length(b))).alias("text")))
    loss = F.transform("loss_spans", lambda s: unescape(F.substring(
        F.get("blocks", s["turn"]), s["start"] + 1, s["length"])))
    return f.withColumns({"turns": turns, "loss_texts": loss})


def digest(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    r = read_back(formatted)
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    r = r.withColumns({"all": turns, "loss": F.array_join("loss_texts", "")})
    return r.select(
        conv_col, F.size("turns").cast("long").alias("n_turns"), F.sha2("all", 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
