"""Chat formatting: tool calls linked to their results, ordered, validated and serialised.

1. Calls and results are hash-joined by conversation and call identifier. Of repeated identifiers the
   first call and the first result in the transcript are linked; every other one that differs in any
   field is a row of its own, ``duplicate``. ``copies`` tells how many calls the identifier has, and on
   a duplicate how many equal rows it stands for.
2. Order. A call's place in the transcript is its first order key. Where a call depends on one that
   has a later or equal key, it moves behind it, round by round, until no dependency is broken; in
   most transcripts none is, and the order costs one join. A call whose key passes its conversation's
   last key by more than the number of its calls lies on or behind a cycle: it gets no key.
3. Arguments are parsed as variants and validated against the schema of the call's tool: JSON type,
   required fields, fields' types, and unknown fields.
4. Every row is one line of canonical JSON: keys sorted, no spaces, nested values included.

Rows are events, not conversations, so no conversation is ever collected into one task; sorting by
(conv_id, order_key, call_id) gives the training text.

Statuses: ``linked`` (a call with its result), ``open`` (without one), ``orphan`` (a result without a
call), ``message`` (any other turn), ``duplicate`` (a later call or result of an identifier). Defined
results: null texts count as empty; null roles make a ``message``. Rows without a conversation or call
id are linked to nothing: calls are ``open``, results ``orphan``; a null conversation id is written as
empty. Arguments that are no JSON object are invalid. Repeated rows of a turn are copies. Empty tables give empty results. Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import named
from starmill.session import stored

REPLY = "reply"

_CALL = ["conv_id", "call_id"]


@dataclass(frozen=True)
class Field:
    """A field of a tool's arguments: its JSON types (as variants name them), and if it must be."""

    kinds: tuple[str, ...]
    required: bool = True


#: Schemas of the tools, by name.
Schemas = Mapping[str, Mapping[str, Field]]
SCHEMAS: Schemas = {REPLY: {"prompt": Field(("STRING",)), "turn": Field(("BIGINT",))}}


def exchanges(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calls, results and other messages of a plain transcript.

    A user's turn calls the tool ``reply``; the assistant's next turn is its result. A call depends
    on the call two turns before, if there is one.
    """
    rows = conversations.select(
        named(conversations, "conv_id").cast("string").alias("conv_id"),
        named(conversations, "turn").cast("long").alias("turn"),
        named(conversations, "role").cast("string").alias("role"),
        F.coalesce(named(conversations, "text"), F.lit("")).alias("text"),
    )

    def call_id(turn: str) -> Column:
        return F.concat(F.lit("call-"), F.expr(turn).cast("string"))

    user = F.col("role") == "user"
    reply = F.col("role") == "assistant"
    place = F.col("turn").isNotNull()
    calls = rows.filter(user & place).select(
        "conv_id", call_id("turn").alias("call_id"), "turn", F.lit(REPLY).alias("name"),
        F.to_json(F.struct(F.col("text").alias("prompt"), "turn")).alias("arguments"),
        F.array(call_id("turn - 2")).alias("after"),
    )
    results = rows.filter(reply & place).select(
        "conv_id", call_id("turn - 1").alias("call_id"), "turn", F.col("text").alias("content")
    )
    others = rows.filter(~F.coalesce((user | reply) & place, F.lit(False)))
    return calls, results, others


def _first(rows: DataFrame, *values: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three parts of the distinct rows, with the number of ``copies``.

    The first of each call identifier in transcript order (its copies are the identifier's rows), the
    others of known identifiers, and the rows whose conversation or call is unknown.
    """
    fields = ["turn", *values]
    distinct = stored(
        rows.groupBy(*_CALL, *fields).agg(F.count("*").alias("copies")), "chat-distinct"
    )
    known = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    named_rows = distinct.filter(known)
    first = named_rows.groupBy(*_CALL).agg(
        F.min(F.struct(*fields)).alias("first"), F.sum("copies").alias("copies")
    )
    others = named_rows.join(first.drop("copies"), _CALL).filter(
        F.struct(*fields) != F.col("first")
    ).drop("first")
    return first.select(*_CALL, "first.*", "copies"), others, distinct.filter(~known)


def topological_keys(calls: DataFrame) -> DataFrame:
    """``conv_id, call_id, order_key``; the key is null on and behind cycles.

    ``calls`` has one row per call, with its ``turn`` and the identifiers it comes ``after``.
    """
    keys = stored(calls.select(*_CALL, F.col("turn").alias("order_key")), "chat-keys")
    needs = stored(
        calls.select(*_CALL, F.explode(F.array_distinct("after")).alias("needed"))
        .join(keys.select("conv_id", F.col("call_id").alias("needed")), ["conv_id", "needed"],
              "left_semi"),
        "chat-needs",
    )
    limits = None
    while True:
        own = needs.join(keys, _CALL)
        other = keys.select("conv_id", F.col("call_id").alias("needed"), F.col("order_key").alias("least"))
        broken = stored(
            own.join(other, ["conv_id", "needed"])
            .filter("order_key IS NOT NULL AND (least IS NULL OR least >= order_key)")
            .groupBy(*_CALL)
            .agg(F.max("least").alias("least"), F.bool_or(F.col("least").isNull()).alias("never")),
            "chat-broken",
        )
        if broken.isEmpty():
            return keys
        if limits is None:
            limits = stored(
                keys.groupBy("conv_id").agg((F.max("order_key") + F.count("*")).alias("most")),
                "chat-limits",
            )
        moved = F.when(
            ~F.col("never") & (F.col("least") + 1 <= F.col("most")), F.col("least") + 1
        )
        keys = stored(
            keys.join(broken, _CALL, "left").join(limits, "conv_id").select(
                *_CALL,
                F.when(F.col("never").isNull(), F.col("order_key")).otherwise(moved)
                .alias("order_key"),
            ),
            "chat-keys",
        )


def errors(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """What is wrong with the arguments of a call, as a list of texts in schema order."""
    parsed = F.try_parse_json(arguments)
    is_object = F.schema_of_variant(parsed).startswith("OBJECT")

    def missing_or_wrong(field: str, want: Field) -> Column:
        value = F.try_variant_get(parsed, f"$.{field}", "variant")
        kind = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
        absent = value.isNull()
        return F.when(absent, F.lit(f"missing {field}") if want.required else None).when(
            ~kind.isin(list(want.kinds)), F.lit(f"wrong type of {field}")
        )

    found = F.array(F.lit("unknown tool"))
    for tool, fields in schemas.items():
        unknown = F.transform(
            F.array_sort(F.array_except(
                F.json_object_keys(arguments), F.array(*[F.lit(f) for f in fields])
            )),
            lambda key: F.concat(F.lit("unknown field "), key),
        )
        problems = F.concat(
            F.array(*[missing_or_wrong(f, want) for f, want in sorted(fields.items())]),
            F.coalesce(unknown, F.array().cast("array<string>")),
        )
        found = F.when(name == tool, F.when(
            F.coalesce(is_object, F.lit(False)), F.array_compact(problems)
        ).otherwise(F.array(F.lit("arguments are no object")))).otherwise(found)
    return found


def canonical(json: Column) -> Column:
    """JSON text with sorted keys and no spaces; null where it is no JSON."""
    return F.to_json(F.try_parse_json(json))


def _line(**fields: Column) -> Column:
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]))


def link_tool_calls(
    calls: DataFrame, results: DataFrame, others: DataFrame, schemas: Schemas = SCHEMAS
) -> DataFrame:
    """One row per call, unmatched result and other message, with its line of JSON."""
    first, more_calls, loose_calls = _first(calls, "name", "arguments", "after")
    called = stored(first, "chat-calls")
    answers, more_results, loose_results = _first(results, "content")
    answered = answers.select(
        *_CALL, F.col("turn").alias("result_turn"), "content", F.lit(True).alias("answered")
    )
    keys = topological_keys(called)
    joined = called.withColumn("called", F.lit(True)).join(answered, _CALL, "full").join(
        keys, _CALL, "left"
    ).withColumn("duplicate", F.lit(False))

    def alone(rows: DataFrame, duplicate: bool, call: bool) -> DataFrame:
        """Calls or results in the columns of ``joined``, linked to nothing."""
        place = F.col("turn").alias("order_key" if call else "result_turn")
        rows = rows.select("*", place, F.lit(call).alias("called"), F.lit(duplicate).alias("duplicate"))
        # The copies of a result count only where the row stands for nothing but them.
        return rows if call or duplicate else rows.drop("copies")

    alone_rows = [
        alone(more_calls, True, True), alone(more_results, True, False),
        alone(loose_calls, False, True), alone(loose_results, False, False),
    ]
    rest = alone_rows[0]
    for rows in [*alone_rows[1:], joined]:
        rest = rest.unionByName(rows, allowMissingColumns=True)
    joined = rest
    is_call = F.coalesce(F.col("called"), F.lit(False))
    wrong = F.when(is_call, errors(F.col("name"), F.col("arguments"), schemas))
    # Canonical arguments are JSON already: they take the place of a marker, not of a string.
    frame = F.concat(
        F.lit('{"arguments":'), F.coalesce(canonical(F.col("arguments")), F.lit("null")), F.lit(","),
        F.substring(_line(
            call_id=F.col("call_id"), content=F.col("content"), name=F.col("name"),
        ), 2, 2**31 - 1),
    )
    orphan = _line(call_id=F.col("call_id"), content=F.col("content"))
    linked = joined.select(
        F.coalesce("conv_id", F.lit("")).alias("conv_id"), "call_id",
        F.coalesce("turn", "result_turn").alias("turn"),
        F.when(is_call, F.col("order_key")).otherwise(F.col("result_turn")).alias("order_key"),
        F.when(F.col("duplicate"), F.lit("duplicate")).when(~is_call, F.lit("orphan")).when(F.col("answered"), F.lit("linked"))
        .otherwise(F.lit("open")).alias("status"),
        F.coalesce("copies", F.lit(0)).cast("long").alias("copies"),
        (is_call & (F.size(F.coalesce(wrong, F.array(F.lit("")))) == 0)).alias("valid"),
        F.coalesce(F.array_join(wrong, "; "), F.lit("")).alias("errors"),
        F.when(is_call, frame).otherwise(orphan).alias("json"),
    )
    plain = others.select(
        F.coalesce("conv_id", F.lit("")).alias("conv_id"), F.lit("").alias("call_id"), "turn", F.col("turn").alias("order_key"),
        F.lit("message").alias("status"), F.lit(1).cast("long").alias("copies"),
        F.lit(True).alias("valid"), F.lit("").alias("errors"),
        _line(content=F.col("text"), role=F.col("role")).alias("json"),
    )
    return linked.unionByName(plain)


def format_chats(conversations: DataFrame) -> DataFrame:
    return link_tool_calls(*exchanges(conversations))
