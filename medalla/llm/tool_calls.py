"""Chat formatting: tool calls linked to their results, in DataFrame functions only.

1. Link: calls and results are hash-joined by conversation and call id.  The
   earliest result of an id stands in its call; further ones are rows of their
   own, so a call with any number of results is no larger than another.
2. Order: a call may depend on others (``after``).  Where every dependency
   comes earlier, the order of ``seq`` is topological already.  A call that
   depends on a later one is delayed: ``delay`` is the largest number of such
   steps on a path of dependencies into it, and (delay, seq) is a topological
   order that leaves alone what needs no change.  Only conversations with a
   dependency on a later call are worked on, round by round; a delay beyond
   the number of such dependencies is a cycle.
3. Validate: arguments are parsed as a variant and checked against the
   function's schema: required and additional properties, and by property type,
   enum, minimum, maximum, minLength and maxLength.
4. Serialise: canonical JSON, keys sorted, no blanks, text escaped only where
   JSON asks for it (control characters as upper-case \\u00XX); integers and
   decimals without trailing zeros, binary floating point as Java prints it.

Scale: rows meet by (conversation, call id); nothing gathers a conversation.  An
id that a third of all rows share is reduced by partial aggregates and joined
over salts.

Defined results: a call without a conversation or id is linked with nothing and
says so; an id used again names its earliest call (smallest seq), later ones
are errors; rows equal in all columns get equal results; an id's results stand
in order of (seq, content); the first result of no call comes out as a row with
the error ``no call``, every result but the first of its id as one with the
error ``further result``; results without a conversation or id are rows with
the error ``no identifier``; a null content is JSON null; null or malformed arguments are an error and serialised as null; an
unknown function or dependency is an error.  Only the named columns are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import checkpoint_root
from .common import salted_join

KEY = ["conversation", "call_id"]

#: Variant types of a JSON schema's types.
TYPES = {
    "string": "STRING",
    "integer": r"BIGINT|DECIMAL\(\d+,0\)",
    "number": r"BIGINT|DOUBLE|FLOAT|DECIMAL.*",
    "boolean": "BOOLEAN",
    "array": "ARRAY.*",
    "object": "OBJECT.*",
    "null": "VOID",
}


def json_string(text: str | Column) -> Column:
    """The text as a JSON string; null is null."""
    array = F.to_json(F.array(text))
    return F.substring(array, F.lit(2), F.length(array) - 2)


def _property_errors(name: str, rule: dict) -> list[Column]:
    path = f"$['{name}']"
    given = F.array_contains("__names", name)
    kind = F.schema_of_variant(F.try_variant_get("__parsed", path, "variant"))
    number, text = F.try_variant_get("__parsed", path, "decimal(38,9)"), F.try_variant_get("__parsed", path, "string")
    typed = kind.rlike(f"^({TYPES[rule['type']]})$") if "type" in rule else F.lit(True)
    wrong = [F.when(given & ~typed, F.lit(f"{name} is no {rule.get('type')}"))]
    checks = {
        "minimum": lambda v: (number < F.lit(v), f"{name} is below {v}"),
        "maximum": lambda v: (number > F.lit(v), f"{name} is above {v}"),
        "minLength": lambda v: (F.char_length(text) < v, f"{name} has less than {v} characters"),
        "maxLength": lambda v: (F.char_length(text) > v, f"{name} has more than {v} characters"),
        "enum": lambda v: (~text.isin([str(x) for x in v]), f"{name} is none of the values allowed"),
    }
    for word, check in checks.items():
        if word in rule:
            failed, says = check(rule[word])
            wrong.append(F.when(given & typed & failed, F.lit(says)))
    return wrong


def argument_errors(schemas: dict[str, dict]) -> Column:
    """Errors of ``__parsed`` (its names in ``__names``) against the schema of ``name``."""
    of_name = F.lit(None)
    for function, schema in schemas.items():
        properties = schema.get("properties", {})
        wrong = [F.when(~F.array_contains("__names", p), F.lit(f"{p} is missing")) for p in schema.get("required", [])]
        for p, rule in properties.items():
            wrong += _property_errors(p, rule)
        if schema.get("additionalProperties", True) is False:
            more = F.array_except("__names", F.array(*[F.lit(p) for p in properties]))
            wrong.append(F.when(F.size(more) > 0, F.concat(F.lit("not in the schema: "), F.array_join(F.sort_array(more), ", "))))
        of_name = F.when(F.col("name") == function, F.array_compact(F.array(*wrong, F.lit(None).cast("string")))).otherwise(of_name)
    unknown = F.when(F.col("name").isNull() | ~F.col("name").isin(list(schemas)), F.array(F.lit("unknown function")))
    no_object = F.when(F.col("__names").isNull() | F.col("__parsed").isNull(), F.array(F.lit("arguments are no JSON object")))
    return F.coalesce(unknown, no_object, of_name, F.array().cast("array<string>"))


def delays(calls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversation, call_id, delay) of calls that don't stay where they are,
    delay null in a cycle; and (conversation, call_id, unknown) dependencies
    that name no call.  ``calls`` has one row for each id."""
    spark = calls.sparkSession
    checkpoint_root(spark)
    asked = calls.select(*KEY, "seq", F.explode("after").alias("on")).distinct()
    named = calls.select("conversation", F.col("call_id").alias("on"), F.col("seq").alias("on_seq"))
    edges = asked.join(named, ["conversation", "on"], "left")
    unknown = edges.filter("on_seq is null").groupBy(*KEY).agg(F.sort_array(F.collect_set("on")).alias("unknown"))
    edges = edges.filter("on_seq is not null").select(*KEY, "on", F.expr("cast(on_seq >= seq as int)").alias("step"))
    odd = edges.groupBy("conversation").agg(F.sum("step").alias("forward")).filter("forward > 0").checkpoint()
    if odd.isEmpty():
        return calls.select(*KEY, F.lit(0).cast("long").alias("delay")).limit(0), unknown
    edges = edges.join(odd, "conversation").checkpoint()
    now = calls.join(odd, "conversation").select(*KEY, "forward", F.lit(0).cast("long").alias("delay")).checkpoint()
    while True:
        of_dependency = now.select("conversation", F.col("call_id").alias("on"), F.col("delay").alias("before"))
        pushed = edges.join(of_dependency, ["conversation", "on"]).groupBy(*KEY).agg(F.max(F.col("before") + F.col("step")).alias("pushed"))
        new = now.join(pushed, KEY, "left").withColumn(
            "next", F.least(F.col("forward") + 1, F.greatest("delay", F.coalesce("pushed", F.lit(0))))
        )
        new = new.select(*KEY, "forward", "delay", "next").checkpoint()
        moved = not new.filter("next <> delay").isEmpty()
        now = new.select(*KEY, "forward", F.col("next").alias("delay"))
        if not moved:
            return now.select(*KEY, F.when(F.col("delay") <= F.col("forward"), F.col("delay")).alias("delay")), unknown


def message(arguments: Column, content: Column) -> Column:
    """Canonical JSON of a call and its result."""
    fields = [
        ("arguments", F.coalesce(arguments, F.lit("null"))),
        ("id", F.coalesce(json_string("call_id"), F.lit("null"))),
        ("name", F.coalesce(json_string("name"), F.lit("null"))),
        ("result", F.coalesce(json_string(content), F.lit("null"))),
    ]
    inner = reduce(lambda a, b: F.concat(a, F.lit(","), b), [F.concat(F.lit(f'"{k}":'), v) for k, v in fields])
    return F.concat(F.lit("{"), inner, F.lit("}"))


def further_results(results: DataFrame, answers: DataFrame) -> DataFrame:
    """A row for every result that its id's row has no room for: each but the
    first of (seq, content), and those without an identifier.  ``answers`` has
    the first result and the number of them for each id; only ids with more
    than one are met with their results."""
    named = F.col("conversation").isNotNull() & F.col("call_id").isNotNull()
    rows = results.select(*KEY, "seq", "content")
    several = answers.filter("n_results > 1").select(*KEY, "n_results", F.struct("result_seq", "content").alias("first"))
    met = salted_join(rows.filter(named), several, KEY, "inner")
    alike = met.groupBy(*met.columns).agg(F.count(F.lit(1)).alias("copies"))
    is_first = F.struct(F.col("seq").alias("result_seq"), "content").eqNullSafe(F.col("first"))
    left = F.col("copies") - F.when(is_first, F.lit(1)).otherwise(F.lit(0))
    alike = alike.withColumn("left", left).filter("left > 0").select(*rows.columns, "n_results", "left")
    one = F.lit(1).cast("long")
    rows = alike.unionByName(rows.filter(~named).withColumns({"n_results": one, "left": one}))
    rows = rows.withColumn("name", F.lit(None).cast("string")).withColumn("__copy", F.explode(F.sequence(one, "left")))
    errors = F.array(F.when(named, F.lit("further result")).otherwise(F.lit("no identifier")))
    return rows.select(
        *KEY, "seq", "name", F.lit(0).cast("long").alias("delay"), "n_results", F.lit(False).alias("valid"), errors.alias("errors"),
        message(F.lit(None), F.col("content")).alias("message"),
    )


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """``calls``: conversation, call_id, seq, name, arguments (JSON), after
    (array of ids).  ``results``: conversation, call_id, seq, content.  Per call,
    per result id without one and per further result: conversation, call_id, seq,
    name, delay, n_results, valid, errors, message (canonical JSON)."""
    calls = calls.select(*KEY, "seq", "name", "arguments", F.coalesce("after", F.expr("cast(array() as array<string>)")).alias("after"))
    known = calls.filter("conversation is not null and call_id is not null")
    first = known.groupBy(*KEY).agg(F.min("seq").alias("first_seq"))
    of_id = salted_join(known, first, KEY, "inner").filter("seq <=> first_seq").select(*KEY, "seq", "after").distinct()
    delayed, unknown = delays(of_id)

    answers = results.filter("conversation is not null and call_id is not null").groupBy(*KEY)
    earliest = F.min(F.struct("seq", "content"))
    answers = answers.agg(F.count("*").alias("n_results"), earliest.alias("r"))
    answers = answers.select(*KEY, "n_results", F.col("r.seq").alias("result_seq"), F.col("r.content").alias("content"))
    info = first.join(answers.hint("shuffle_hash"), KEY, "full").join(unknown, KEY, "left")
    info = info.join(delayed.withColumn("listed", F.lit(True)), KEY, "left").select(
        *KEY, "first_seq", F.coalesce("n_results", F.lit(0)).alias("n_results"), "result_seq", "content", "unknown", "listed", "delay"
    )
    linked = salted_join(calls, info, KEY, "left").withColumn("call", F.lit(True))
    orphans = info.join(first.select(*KEY), KEY, "left_anti").withColumn("call", F.lit(False))
    rows = linked.unionByName(orphans, allowMissingColumns=True)
    rows = rows.withColumn("__parsed", F.try_parse_json("arguments")).withColumn("__names", F.json_object_keys("arguments"))

    cyclic = F.col("listed") & F.col("delay").isNull()
    again = F.col("seq") > F.col("first_seq")
    own = F.array_compact(
        F.array(
            F.when(~F.col("call"), F.lit("no call")),
            F.when(F.col("call") & (F.col("conversation").isNull() | F.col("call_id").isNull()), F.lit("no identifier")),
            F.when(again, F.lit("identifier used before")),
            F.when(F.coalesce(cyclic, F.lit(False)), F.lit("dependency cycle")),
            F.when(F.size("unknown") > 0, F.concat(F.lit("depends on no call: "), F.array_join("unknown", ", "))),
            F.when(F.col("n_results") > 1, F.lit("more than one result")),
        )
    )
    errors = F.when(F.col("call"), F.concat(own, argument_errors(schemas))).otherwise(own)
    canonical = F.when(F.col("__names").isNotNull(), F.to_json("__parsed"))
    content = F.when(F.coalesce(again, F.lit(False)), F.lit(None)).otherwise(F.col("content"))
    linked = rows.select(
        *KEY,
        "seq",
        "name",
        F.when(F.coalesce(cyclic, F.lit(False)), F.lit(None)).otherwise(F.coalesce("delay", F.lit(0))).cast("long").alias("delay"),
        F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"),
        (F.size(errors) == 0).alias("valid"),
        errors.alias("errors"),
        message(canonical, content).alias("message"),
    )
    return linked.unionByName(further_results(results, answers))


#: Schema of the calls that turns stand for.
REPLY = {
    "reply": {
        "required": ["prompt", "turn", "words"],
        "properties": {
            "prompt": {"type": "string", "minLength": 16},
            "turn": {"type": "integer", "minimum": 0},
            "words": {"type": "integer", "minimum": 3, "maximum": 30},
        },
        "additionalProperties": False,
    }
}


def turns_as_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each user turn as a call of ``reply``, and each assistant turn as the result
    of the call a turn before.  A call depends on the user turn two before it; but
    one in seven, by conversation and turn, depends on the one two after it, which
    then depends on none."""
    name = lambda back: F.concat_ws("-", F.col("conv_id").cast("string"), (F.col("turn") - back).cast("string"))
    words = F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"\S+"), F.lit(0)))
    late = lambda turn: F.pmod(F.col("conv_id") + F.floor(turn / 2), F.lit(7)) == 3
    after = F.when(late(F.col("turn")), F.array(name(-2))).when((F.col("turn") >= 2) & ~late(F.col("turn") - 2), F.array(name(2)))
    calls = conversations.filter("role = 'user'").select(
        F.col("conv_id").alias("conversation"),
        name(0).alias("call_id"),
        F.col("turn").alias("seq"),
        F.lit("reply").alias("name"),
        F.to_json(F.struct(words.alias("words"), F.col("text").alias("prompt"), "turn")).alias("arguments"),
        F.coalesce(after, F.expr("cast(array() as array<string>)")).alias("after"),
    )
    results = conversations.filter("role = 'assistant'").select(
        F.col("conv_id").alias("conversation"), name(1).alias("call_id"), F.col("turn").alias("seq"), F.col("text").alias("content")
    )
    return calls, results


def other_turns(conversations: DataFrame) -> DataFrame:
    """The turns that ``turns_as_calls`` leaves out, a row for each: those of the
    role ``system`` (status ``no call``) and of any other or none (``unknown
    role``), with the message as canonical JSON."""
    status = F.when(F.col("role") == "system", F.lit("no call")).otherwise(F.lit("unknown role"))
    value = lambda c: F.coalesce(json_string(c), F.lit("null"))
    message = F.concat(F.lit('{"content":'), value("text"), F.lit(',"role":'), value("role"), F.lit("}"))
    others = conversations.filter("role is null or role not in ('user', 'assistant')")
    return others.select("conv_id", "turn", "role", status.alias("status"), message.alias("message"))
