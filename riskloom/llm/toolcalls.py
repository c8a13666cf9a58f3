"""Tool-call linking: calls and results joined by identifier, ordered, checked, serialised."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.base import stored, table
from riskloom.operators.joins import join_hot_split

#: What a conversation's turns are taken as: a user's turn calls `reply`, a system's turn
#: calls `configure`; an assistant's turn is the result of the turn before it.
SCHEMAS = {
    "reply": {
        "type": "object",
        "required": ["text", "turn"],
        "properties": {"text": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}},
        "additionalProperties": False,
    },
    "configure": {
        "type": "object",
        "required": ["text"],
        "properties": {"text": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}},
        "additionalProperties": False,
    },
}
TYPES = {
    "string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict, "null": type(None),
}


def problems(value, schema: dict, at: str = "$") -> list[str]:
    """Where ``value`` breaks ``schema``: type, enum, required, properties, items, bounds."""
    kind = schema.get("type")
    if kind is not None:
        kinds = kind if isinstance(kind, list) else [kind]
        whole = isinstance(value, float) and value.is_integer()
        fits = any(
            isinstance(value, TYPES[k]) and not (isinstance(value, bool) and k in ("integer", "number")) or k == "integer" and whole
            for k in kinds
        )
        if not fits:
            return [f"{at}: not {'/'.join(kinds)}"]
    found = []
    if "enum" in schema and value not in schema["enum"]:
        found.append(f"{at}: not in enum")
    if isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            found.append(f"{at}: too short")
        if len(value) > schema.get("maxLength", len(value)):
            found.append(f"{at}: too long")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value):
            found.append(f"{at}: below minimum")
        if value > schema.get("maximum", value):
            found.append(f"{at}: above maximum")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                found += problems(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties", True) is False:
                found.append(f"{at}.{k}: not allowed")
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            found += problems(x, schema["items"], f"{at}[{i}]")
    return found


def canonical(value) -> str:
    """JSON with sorted keys, no blanks and no escapes beyond the needed ones."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _no_constant(name: str):
    raise ValueError(name)


def check_arguments(name: str | None, arguments: str | None, schemas: dict) -> tuple[object, list[str]]:
    """The parsed arguments and what is wrong with them."""
    try:
        value = json.loads(arguments if arguments is not None else "", parse_constant=_no_constant)
    except (ValueError, RecursionError):
        return None, ["$: not JSON"]
    if name not in schemas:
        return value, ["$: unknown tool"]
    return value, problems(value, schemas[name])


def depths(nodes: DataFrame) -> DataFrame:
    """Longest way from each node to the start of its chains: id, depth; null on or behind a circle.

    ``nodes`` has id and parent (null, or not an id, at a start). Pointers double in each
    round, so a chain of a million messages takes 20 joins. They stop at ids that have
    several parents; those are settled level by level. Rounds are written tables.
    """
    edges = nodes.select("id", "parent").where("id IS NOT NULL").distinct()
    known = edges.select(F.col("id").alias("_p")).distinct()
    edges = stored(edges.join(known, edges["parent"] == known["_p"], "left").select("id", F.col("_p").alias("up")), "edges")
    ids = edges.groupBy("id").agg(F.min("up").alias("up"), (F.count("up") > 1).alias("fork"))
    at = ids.select(
        "id", F.when(~F.col("fork"), F.col("up")).alias("up"), F.col("id").alias("top"), F.col("fork").alias("top_fork"),
        F.when(F.col("fork") | F.col("up").isNull(), 0).otherwise(1).cast("long").alias("steps"),
    )
    at = stored(at, "depths")
    limit, reach = at.count(), 1
    while reach <= limit and not at.where("up IS NOT NULL").isEmpty():
        up = at.select(*[F.col(c).alias(f"_{c}") for c in at.columns])
        at = at.join(up, at["up"] == up["_id"], "left").select(
            "id", F.col("_up").alias("up"), F.coalesce("_top", "top").alias("top"),
            F.coalesce("_top_fork", "top_fork").alias("top_fork"), (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps"),
        )
        at, reach = stored(at, "depths"), reach * 2
    forks = at.where("top_fork AND id = top").select("id")
    if forks.isEmpty():
        return at.select("id", F.when(F.col("up").isNull(), F.col("steps")).alias("depth"))
    # From each parent of a fork to the start or the fork above; no way out of a circle.
    above = at.select(F.col("id").alias("_id"), F.col("up").alias("_up"), "top", "top_fork", (F.col("steps") + 1).alias("steps"))
    links = edges.where("up IS NOT NULL").join(forks, "id").join(above, F.col("up") == above["_id"])
    links = stored(links.select("id", "top", "top_fork", F.when(F.col("_up").isNull(), F.col("steps")).alias("steps")), "forks")

    def value() -> Column:
        return F.col("steps") + F.when(F.col("top_fork"), F.col("_depth")).otherwise(0)

    done, settled = forks.where("false").select(F.col("id").alias("_f"), F.lit(0).cast("long").alias("_depth")), -1
    while settled < (settled := done.count()):
        found = links.join(done, links["top"] == done["_f"], "left").select(F.col("id").alias("_f"), value().alias("_v"))
        done = found.groupBy("_f").agg(F.max("_v").alias("_depth"), (F.count("_v") == F.count(F.lit(1))).alias("_all"))
        done = stored(done.where("_all").drop("_all"), "forks")
    return at.join(done, at["top"] == done["_f"], "left").select("id", F.when(F.col("up").isNull(), value()).alias("depth"))


LINKED = (
    "id string, conv_id long, depth long, status string, valid boolean, problems string, n_results long, message string, "
    "n_calls long, copies long"
)


def _serialise(schemas: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.string()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("status", pa.string()), ("valid", pa.bool_()), ("problems", pa.string()), ("n_results", pa.int64()), ("message", pa.string()), ("n_calls", pa.int64()), ("copies", pa.int64())])
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                rows = []
                for r in batch.slice(low, 512).to_pylist():
                    body = {"id": r["id"], "order": r["depth"]}
                    if r["call"]:
                        value, wrong = check_arguments(r["name"], r["arguments"], schemas)
                        status = "cycle" if r["depth"] is None else "repeated" if r["n_calls"] > 1 else "linked" if r["n_results"] == 1 else "open" if not r["n_results"] else "ambiguous"
                        body |= {"name": r["name"], "arguments": value}
                    else:
                        wrong, status = [], "repeated" if r["n_calls"] else "orphan"
                    if r["answer"]:
                        body["result"] = r["content"]
                    rows.append({
                        "id": r["id"], "conv_id": r["conv_id"], "depth": r["depth"], "status": status,
                        "valid": not wrong if r["call"] else None, "problems": "; ".join(wrong) or None,
                        "n_results": r["n_results"], "message": canonical(body), "n_calls": r["n_calls"], "copies": r["copies"],
                    })
                yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict = SCHEMAS) -> DataFrame:
    """Every distinct call and every distinct result, linked by id.

    ``calls``: conv_id, id, parent (the id it depends on), name, arguments (JSON text);
    ``results``: conv_id, id, content. An id with one distinct call has a row per distinct
    result, or one row without any. An id with several calls has a row per distinct call and
    a row per distinct result, as nothing says which belong together. A result id that no
    call has gives a row per distinct result (status orphan).

    Columns: id, conv_id, depth (place in the topological order: after everything that a call
    of this id depends on), status (linked, open: no result, ambiguous: several, repeated: the
    call id is used several times, cycle, orphan), valid and problems (of the row's own
    arguments; null without a call), n_results and n_calls (rows of this id, equal ones
    too), message, canonical JSON, and copies, the equal rows this one stands for (equal
    results if it has a result, otherwise equal calls).

    Only equal rows are folded. Rows of an id with very many of them stay where they are and
    meet its one row of counts by broadcast. Null ids are left out on both sides: nothing can
    refer to them. Null arguments are not JSON; a null content is JSON null. Empty tables
    give an empty result; other columns are not looked at.
    """
    asked = calls.where("id IS NOT NULL").groupBy("id", "conv_id", "parent", "name", "arguments").agg(F.count(F.lit(1)).alias("copies"))
    asked = stored(asked, "calls")
    given = results.where("id IS NOT NULL").groupBy("id", "conv_id", "content").agg(F.count(F.lit(1)).alias("copies"))
    given = stored(given, "results")
    # The smallest call is the only one where it is used.
    one = asked.groupBy("id").agg(
        F.count(F.lit(1)).alias("kinds"), F.sum("copies").alias("n_calls"), F.min(F.struct("conv_id", "name", "arguments")).alias("c")
    )
    one = one.withColumn("c", F.when(F.col("kinds") == 1, F.col("c")))
    got = given.groupBy("id").agg(F.sum("copies").alias("n_results"))
    ids = one.join(got, "id", "full").join(depths(asked.select("id", "parent")), "id", "left")
    ids = stored(ids.na.fill(0, ["kinds", "n_calls", "n_results"]), "ids")
    counts = ["id", "depth", "n_calls", "n_results"]
    nothing, yes, no = F.lit(None).cast("string").alias("content"), F.lit(True), F.lit(False)
    open_calls = ids.where("kinds = 1 AND n_results = 0").select(
        *counts, "c.conv_id", "c.name", "c.arguments", nothing, F.col("n_calls").alias("copies"), yes.alias("call"), no.alias("answer")
    )
    repeated = join_hot_split(asked, ids.where("kinds > 1").select(*counts), "id").select(
        *counts, "conv_id", "name", "arguments", nothing, "copies", yes.alias("call"), no.alias("answer")
    )
    answers = join_hot_split(given, ids.where("n_results > 0").select(*counts, "kinds", "c"), "id").select(
        *counts, F.when(F.col("kinds") == 1, F.col("c.conv_id")).otherwise(F.col("conv_id")).alias("conv_id"), "c.name", "c.arguments",
        "content", "copies", (F.col("kinds") == 1).alias("call"), yes.alias("answer"),
    )
    return open_calls.unionByName(repeated).unionByName(answers).mapInArrow(_serialise(schemas), LINKED)


def calls_and_results(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns as calls and results, by the rule at SCHEMAS. An id is conv_id:turn of the
    call; a call depends on the call two turns before it."""
    ident = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    named = conversations.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    arguments = F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("text"), F.col("turn").alias("turn")))
    before = F.concat_ws(":", F.col("conv_id").cast("string"), (F.col("turn") - 2).cast("string"))
    calls = named.where("role IN ('user', 'system')").select(
        F.col("conv_id").cast("long").alias("conv_id"), ident.alias("id"), before.alias("parent"),
        F.when(F.col("role") == "user", "reply").otherwise("configure").alias("name"), arguments.alias("arguments"),
    )
    back = F.concat_ws(":", F.col("conv_id").cast("string"), (F.col("turn") - 1).cast("string"))
    results = named.where("role = 'assistant'").select(
        F.col("conv_id").cast("long").alias("conv_id"), back.alias("id"), F.col("text").alias("content")
    )
    return calls, results


def op6_link_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return link_calls(*calls_and_results(stored(turns, "turns")))
