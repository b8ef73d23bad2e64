"""Task files (YAML) -> flat task rows and dependency edges.

Scan: whole files as text (``spark.read.text(wholetext=True)``). Decode: the
only Python step — YAML to canonical JSON in ``mapInPandas`` (one Arrow batch
of files at a time). Everything after that is built-in: ``from_json`` /
``get_json_object``, ``posexplode``, ``coalesce`` and windows bounded by one
document.

``render_task_docs`` goes the other way: it writes the fleet's task table out
as task files (three layouts), so the whole pipeline can run on data Spark
derives from the input tables.
"""

from __future__ import annotations

import json

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keelson.functions import expr as X
from keelson.operators.scan import settled

TASK_SCHEMA = ("STRUCT<id: STRING, name: STRING, description: STRING, priority: STRING, "
               "status: STRING, dependencies: ARRAY<STRING>>")
# Keys of a keyed phase object that are phase metadata, not tasks (fixed values).
PHASE_META_KEYS = ["name", "priority", "estimated_hours", "description", "dependencies", "purpose"]
PRIORITY_TEXT = {0: "critical", 1: "high", 2: "medium", 3: "low"}
STATUS_TEXT = {"open": "pending", "in_progress": "in-progress", "closed": "completed"}


# ---------------------------------------------------------------- T1 scan + decode

def scan_task_docs(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: (path, text)."""
    return (spark.read.text(path, wholetext=True)
            .select(F.input_file_name().alias("path"), F.col("value").alias("text")))


DOC_SEPARATOR = "\n---\n"


def write_task_bundles(docs: DataFrame, path: str) -> None:
    """Write (path, text) as YAML streams: each document starts with its path as a
    comment, documents are set apart by ``---``."""
    docs.select(F.concat(F.lit("# path: "), "path", F.lit("\n"), "text")).write.option("lineSep", DOC_SEPARATOR).text(path)


def scan_task_bundles(spark: SparkSession, path: str) -> DataFrame:
    """T1 for YAML streams: one row (path, text) per document; files are split
    between tasks at document bounds."""
    rows = spark.read.option("lineSep", DOC_SEPARATOR).text(path).filter(F.trim("value") != "")
    return rows.select(F.regexp_extract("value", r"^# path: ([^\n]*)", 1).alias("path"), F.col("value").alias("text"))


#: bytes of text that a decoding task parses at a time: what it holds in Python objects follows this, not the Arrow batch
SLICE_BYTES = 1 << 20


def _decode_batches(it):
    import yaml  # imported on the executor

    loader = getattr(yaml, "CSafeLoader", yaml.SafeLoader)  # libyaml when present
    for batch in it:
        for lo, hi in _slices(batch.column("text")):
            yield _decode(batch.slice(lo, hi - lo), yaml, loader)


def _slices(texts, most: int = SLICE_BYTES):
    """Bounds of runs of rows with at most ``most`` bytes of text (or one row) each."""
    lo = size = 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        if i > lo and size + (n or 0) > most:
            yield lo, i
            lo, size = i, 0
        size += n or 0
    if lo < len(texts):
        yield lo, len(texts)


def _load(text, yaml, loader):
    """``yaml.load``: texts, lists and mappings by text, which task files hold most of, are taken
    from the composed nodes; the loader makes all else, and files with anchors as a whole."""
    if "&" in text:
        return yaml.load(text, Loader=loader)
    made = loader(text)

    def value(node):
        if node.tag == "tag:yaml.org,2002:str" and isinstance(node, yaml.ScalarNode):
            return node.value
        if node.tag == "tag:yaml.org,2002:seq" and isinstance(node, yaml.SequenceNode):
            return [value(x) for x in node.value]
        if node.tag == "tag:yaml.org,2002:map" and isinstance(node, yaml.MappingNode) and all(
                k.tag == "tag:yaml.org,2002:str" and isinstance(k, yaml.ScalarNode) for k, _ in node.value):
            return {k.value: value(v) for k, v in node.value}
        return made.construct_object(node, deep=True)
    try:
        node = made.get_single_node()
        return None if node is None else value(node)
    finally:
        made.dispose()


def _decode(batch, yaml, loader):
    docs, errs = [], []
    for text in batch.column("text").to_pylist():
        try:
            data = _load(text, yaml, loader) if text is not None else None
            if not isinstance(data, dict):
                raise ValueError("top level is not a mapping")
            docs.append(json.dumps(data, default=str))
            errs.append(None)
        except Exception as e:  # noqa: BLE001 - bad files go to the error column
            docs.append(None)
            errs.append(f"{type(e).__name__}: {e}")
    return pa.RecordBatch.from_arrays([batch.column("path"), pa.array(docs, pa.string()), pa.array(errs, pa.string())], ["path", "doc", "error"])


def decode_task_docs(files: DataFrame) -> DataFrame:
    """T1 decode: YAML (or JSON) text -> canonical JSON ``doc``; files that do
    not parse keep a row with ``error`` set instead of stopping the job."""
    return files.select("path", "text").mapInArrow(_decode_batches, "path STRING, doc STRING, error STRING")


# ---------------------------------------------------------------- T2..T11 flatten

def _is_obj(c: Column) -> Column:
    return F.startswith(F.ltrim(c), F.lit("{"))


def _task_cols(t: Column):
    return F.from_json(t, TASK_SCHEMA)


def _raw_flags(keyed: bool = False):
    """Fields as written in the file, for validation (V2, V3); in the keyed
    layout the object key is the id."""
    return [(F.lit(True) if keyed else F.col("t.id").isNotNull()).alias("has_id"), F.col("t.name").isNotNull().alias("has_name"),
            F.col("t.description").isNotNull().alias("has_description"),
            F.col("t.priority").alias("raw_priority"), F.col("t.status").alias("raw_status")]


def project_name(doc: Column) -> Column:
    """Metadata (else a 'project' object) -> project / project_name / name."""
    meta = F.coalesce(F.get_json_object(doc, "$.metadata"),
                      F.when(_is_obj(F.get_json_object(doc, "$.project")), F.get_json_object(doc, "$.project")))
    meta = F.when(_is_obj(meta), meta)
    return F.coalesce(F.get_json_object(meta, "$.project"), F.get_json_object(meta, "$.project_name"),
                      F.get_json_object(meta, "$.name"), F.lit("unknown"))


def _phases_shape(docs: DataFrame) -> DataFrame:
    """phases[].tasks[] (phase objects that have a 'tasks' key)."""
    p = docs.select("path", F.posexplode(F.from_json("doc", "STRUCT<phases: ARRAY<STRING>>")["phases"])
                    .alias("phase_pos", "phase"))
    p = p.filter(_is_obj(F.col("phase")) &
                 F.map_contains_key(F.from_json("phase", "MAP<STRING, STRING>"), F.lit("tasks")))
    pname = F.coalesce(F.get_json_object("phase", "$.name"), F.get_json_object("phase", "$.id"), F.lit("default"))
    t = p.select("path", "phase_pos", X.phase_label(pname).alias("label"),
                 F.posexplode(F.from_json("phase", "STRUCT<tasks: ARRAY<STRING>>")["tasks"]).alias("task_pos", "task"))
    t = t.filter(_is_obj(F.col("task"))).withColumn("t", _task_cols(F.col("task")))
    return t.select("path", "phase_pos", "task_pos", "label", F.col("t.id").alias("raw_id"),
                    F.coalesce("t.name", "t.description", F.lit("Unnamed task")).alias("title0"),
                    F.substring(F.coalesce("t.name", "t.description", F.lit("Unnamed task")), 1, 100).alias("title"),
                    "t.priority", "t.status", "t.dependencies", F.lit(1).alias("shape_rank"), *_raw_flags())


def _flat_shape(docs: DataFrame) -> DataFrame:
    """Top-level tasks[]; label is the id text before the first '-'."""
    t = docs.select("path", F.lit(0).alias("phase_pos"),
                    F.posexplode(F.from_json("doc", "STRUCT<tasks: ARRAY<STRING>>")["tasks"]).alias("task_pos", "task"))
    t = t.filter(_is_obj(F.col("task"))).withColumn("t", _task_cols(F.col("task")))
    return t.select("path", "phase_pos", "task_pos", F.lit(None).cast("string").alias("label"),
                    F.col("t.id").alias("raw_id"),
                    F.coalesce("t.name", "t.description", F.lit("Unnamed task")).alias("title0"),
                    F.substring(F.coalesce("t.name", "t.description", F.lit("Unnamed task")), 1, 100).alias("title"),
                    "t.priority", "t.status", "t.dependencies", F.lit(2).alias("shape_rank"), *_raw_flags())


def _keyed_shape(docs: DataFrame) -> DataFrame:
    """T4: 'phaseN…' keys (sorted as text), tasks from the nested 'tasks'
    object, else from every object-valued non-meta key of the phase."""
    top = docs.select("path", F.explode(F.from_json("doc", "MAP<STRING, STRING>")).alias("pkey", "phase"))
    top = top.filter(F.col("pkey").rlike("^phase[0-9]") & _is_obj(F.col("phase")))
    w = Window.partitionBy("path").orderBy("pkey")  # a document's phase keys
    top = top.withColumn("phase_pos", (F.row_number().over(w) - 1).cast("int"))
    pm = F.from_json("phase", "MAP<STRING, STRING>")
    nested = F.from_json(F.get_json_object("phase", "$.tasks"), "MAP<STRING, STRING>")
    fallback = F.map_filter(pm, lambda k, v: (~k.isin(*PHASE_META_KEYS)) & F.startswith(F.ltrim(v), F.lit("{")))
    tasks = F.when(F.coalesce(F.size(nested), F.lit(0)) > 0, nested).otherwise(fallback)
    label = X.slugify(F.coalesce(F.get_json_object("phase", "$.name"), F.col("pkey")))
    t = top.select("path", "phase_pos", label.alias("label"),
                   F.posexplode(F.map_entries(tasks)).alias("task_pos", "kv"))
    t = t.filter(_is_obj(F.col("kv.value"))).withColumn("t", _task_cols(F.col("kv.value")))
    name = F.coalesce("t.name", "t.description", F.col("kv.key"))
    title = F.when(F.length(name) > 100, F.concat(F.substring(name, 1, 100), F.lit("..."))).otherwise(name)
    return t.select("path", "phase_pos", "task_pos", "label", F.col("kv.key").alias("raw_id"),
                    name.alias("title0"), title.alias("title"), "t.priority", "t.status", "t.dependencies",
                    F.lit(3).alias("shape_rank"), *_raw_flags(keyed=True))


def flatten_tasks(decoded: DataFrame) -> DataFrame:
    """One row per task of every document.

    Shape precedence per document (T5): phases, else flat, else keyed — the
    first shape that yields a task wins (``min(shape_rank)`` per path).
    Running index ``idx`` counts all earlier tasks of the document; a task
    without an id gets ``task-<idx>`` (T9).
    """
    docs = decoded.filter(F.col("doc").isNotNull()).select("path", "doc")
    rows = _phases_shape(docs).unionByName(_flat_shape(docs)).unionByName(_keyed_shape(docs))
    best = rows.groupBy("path").agg(F.min("shape_rank").alias("shape_rank"))
    rows = rows.join(best, ["path", "shape_rank"], "left_semi")
    w = Window.partitionBy("path").orderBy("phase_pos", "task_pos")  # one document
    rows = rows.withColumn("idx", (F.row_number().over(w) - 1).cast("bigint"))
    tid = F.coalesce(F.col("raw_id"), F.concat(F.lit("task-"), F.col("idx").cast("string")))
    label = F.when(F.col("shape_rank") == 2, X.flat_label(tid)).otherwise(F.col("label"))
    proj = docs.select("path", project_name(F.col("doc")).alias("project"))
    return (rows.join(proj, "path")
            .select("path", "project", tid.alias("task_id"), "title",
                    X.priority_code(F.col("priority")).alias("priority"),
                    X.status_code(F.col("status")).alias("status"), label.alias("label"),
                    F.col("phase_pos").cast("bigint").alias("phase_pos"),
                    F.col("task_pos").cast("bigint").alias("task_pos"), "idx",
                    F.coalesce("dependencies", F.array().cast("array<string>")).alias("dependencies"),
                    F.element_at(F.array(F.lit("phases"), F.lit("flat"), F.lit("keyed")), F.col("shape_rank"))
                    .alias("shape"), "has_id", "has_name", "has_description", "raw_priority", "raw_status"))


def dependency_edges(tasks: DataFrame) -> DataFrame:
    """(path, project, child, parent); parents unknown in the same
    document are dropped (left-semi join on the document's ids)."""
    e = tasks.select("path", "project", F.col("task_id").alias("child"), "idx",
                     F.posexplode("dependencies").alias("dep_pos", "parent")) \
        .withColumn("dep_pos", F.col("dep_pos").cast("bigint"))
    ids = tasks.select("path", F.col("task_id").alias("parent"))
    return e.join(ids, ["path", "parent"], "left_semi")


# ---------------------------------------------------------------- T12..T17

def migration_actions(tasks: DataFrame, edges: DataFrame) -> DataFrame:
    """Ordered action table: create every task, add every in-document
    edge, then close closed tasks (in-progress is not replayed, as in the
    source). Order within a document: (step, idx, dep_pos)."""
    create = tasks.select("path", "project", F.lit(1).alias("step"), "idx", F.lit(0).cast("bigint").alias("dep_pos"),
                          F.lit("create").alias("action"), "task_id", F.lit(None).cast("string").alias("parent"),
                          "title", "priority", "label")
    dep = edges.select("path", "project", F.lit(2).alias("step"), "idx", "dep_pos", F.lit("add_dependency").alias("action"),
                       F.col("child").alias("task_id"), "parent", F.lit(None).cast("string").alias("title"),
                       F.lit(None).cast("int").alias("priority"), F.lit(None).cast("string").alias("label"))
    close = tasks.filter(F.col("status") == "closed").select(
        "path", "project", F.lit(3).alias("step"), "idx", F.lit(0).cast("bigint").alias("dep_pos"),
        F.lit("close").alias("action"), "task_id", F.lit(None).cast("string").alias("parent"),
        F.lit(None).cast("string").alias("title"), F.lit(None).cast("int").alias("priority"),
        F.lit(None).cast("string").alias("label"))
    return create.unionByName(dep).unionByName(close)


def migration_reconcile(source: DataFrame, target: DataFrame) -> DataFrame:
    """Per project — tasks in the files missing from the tracker, extras
    in the tracker, ids present more than once, status mismatches, counts
    (one full outer join on (project, task_id) after per-key counts)."""
    s = source.groupBy("project", "task_id").agg(F.count(F.lit(1)).alias("n_src"), F.max("status").alias("s_status"))
    t = target.groupBy("project", "task_id").agg(F.count(F.lit(1)).alias("n_tgt"), F.max("status").alias("t_status"))
    j = s.join(t, ["project", "task_id"], "full")
    return j.groupBy("project").agg(
        F.sum(F.coalesce("n_src", F.lit(0))).cast("bigint").alias("source_tasks"),
        F.sum(F.coalesce("n_tgt", F.lit(0))).cast("bigint").alias("target_tasks"),
        F.sum(F.when(F.col("n_tgt").isNull(), 1).otherwise(0)).cast("bigint").alias("missing"),
        F.sum(F.when(F.col("n_src").isNull(), 1).otherwise(0)).cast("bigint").alias("extra"),
        F.sum(F.when((F.col("n_src") > 1) | (F.col("n_tgt") > 1), 1).otherwise(0)).cast("bigint").alias("duplicates"),
        F.sum(F.when(F.col("s_status") != F.col("t_status"), 1).otherwise(0)).cast("bigint").alias("status_mismatch"))


APPROX_LINE = r"^\s*-?\s*(id:|name:|description:)"


def approx_task_count(files: DataFrame) -> DataFrame:
    """Lines that look like id/name/description keys, halved (floor)."""
    lines = files.select("path", F.explode(F.split("text", "\n")).alias("line"))
    return (lines.groupBy("path")
            .agg(F.sum(F.when(F.col("line").rlike(APPROX_LINE), 1).otherwise(0)).cast("bigint").alias("lines"))
            .withColumn("approx_tasks", F.floor(F.col("lines") / 2).cast("bigint")))


def external_dependencies(decoded: DataFrame) -> DataFrame:
    """Dependencies.external[] rows, one per named task."""
    schema = ("STRUCT<dependencies: STRUCT<external: ARRAY<STRUCT<project: STRING, location: STRING, "
              "purpose: STRING, tasks: ARRAY<STRING>>>>>")
    e = decoded.filter(F.col("doc").isNotNull()).select(
        "path", F.posexplode(F.from_json("doc", schema)["dependencies"]["external"]).alias("pos", "e"))
    return e.select("path", F.col("pos").cast("bigint").alias("pos"), F.col("e.project").alias("ext_project"),
                    F.col("e.location").alias("location"), F.col("e.purpose").alias("purpose"),
                    F.explode_outer("e.tasks").alias("task"))


def update_log(decoded: DataFrame) -> DataFrame:
    """updates[] entries 'YYYY-MM-DD: text' -> (date, text)."""
    u = decoded.filter(F.col("doc").isNotNull()).select(
        "path", F.posexplode(F.from_json("doc", "STRUCT<updates: ARRAY<STRING>>")["updates"]).alias("pos", "entry"))
    pat = r"^(\d{4}-\d{2}-\d{2}):\s*(.*)$"
    return u.select("path", F.col("pos").cast("bigint").alias("pos"),
                    F.to_date(F.nullif(F.regexp_extract("entry", pat, 1), F.lit(""))).alias("date"),
                    F.when(F.col("entry").rlike(pat), F.regexp_extract("entry", pat, 2)).otherwise(F.col("entry"))
                    .alias("text"))


def agents_flat(agent_json: DataFrame) -> DataFrame:
    """Agent registry rows (nested profile/behavior flattened). The document is
    parsed once, to a VARIANT, whose fields are read by path and type; a text that is no
    JSON, or a field of another type, gives nulls."""
    a = agent_json.select(F.try_parse_json("doc").alias("v"))

    def get(path, kind="string"):
        return F.try_variant_get("v", f"$.{path}", kind)
    return a.select(*[get(c).alias(c) for c in ("name", "type", "scope", "repo", "contact_policy")],
                    F.size(get("profile.capabilities", "array<string>")).cast("bigint").alias("n_capabilities"),
                    get("behavior.max_concurrent_reviews", "int").alias("max_concurrent"),
                    get("behavior.review_timeout_hours", "int").alias("timeout_hours"),
                    F.to_timestamp(get("created_at")).alias("created_at"))


def agent_capabilities(agent_json: DataFrame) -> DataFrame:
    """One row per (agent, capability)."""
    a = agent_json.select(F.try_parse_json("doc").alias("v"))
    return a.select(F.try_variant_get("v", "$.name", "string").alias("name"), F.try_variant_get("v", "$.scope", "string").alias("scope"),
                    F.explode(F.try_variant_get("v", "$.profile.capabilities", "array<string>")).alias("capability"))


def agent_behavior(agent_json: DataFrame) -> DataFrame:
    """Every key of the agents' ``behavior``, known or not, whatever its type: one row
    per (agent, key) with the value's type and its text."""
    a = agent_json.select(F.try_parse_json("doc").alias("v"))
    return agent_json.sparkSession.sql("""
        SELECT try_variant_get(v, '$.name', 'string') AS name, try_variant_get(v, '$.scope', 'string') AS scope, b.key AS key,
               lower(schema_of_variant(b.value)) AS kind, if(schema_of_variant(b.value) LIKE 'OBJECT%', to_json(b.value), cast(b.value AS string)) AS value
        FROM {a}, LATERAL variant_explode(try_variant_get(v, '$.behavior', 'variant')) AS b""", a=a)


def write_tasks(tasks: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", buckets: int = 64) -> None:
    """T18 sink: flattened tasks (parquet or JSON), partitioned by a hash bucket
    of the project, so that the number of folders doesn't follow the projects."""
    bucket = F.pmod(F.xxhash64("project"), F.lit(buckets)).cast("int")
    tasks.withColumn("project_bucket", bucket).repartition("project_bucket").write.mode(mode).partitionBy("project_bucket").format(fmt).save(path)


def read_tasks(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The tasks that ``write_tasks`` wrote."""
    return spark.read.format(fmt).load(path).drop("project_bucket")


# ---------------------------------------------------------------- rendering (data derived from the fleet tables)

def _q(c: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('\\"')), F.lit('"'))


def render_task_docs(tasks: DataFrame, deps: DataFrame, updated: DataFrame | None = None,
                     per_file: int = 20) -> DataFrame:
    """Write the task table out as YAML task files, ``per_file`` tasks each,
    cycling through the three layouts (phases / flat / keyed). Fields left
    out on purpose: 'not specified' tasks have only a description, 'low'
    tasks in the phases layout have no id. Returns (path, text)."""
    t = tasks.select("project", "task_id", "title", "status", "priority", "label", "seq")
    t = t.withColumn("file_no", F.floor((F.col("seq") - 1) / per_file).cast("bigint")) \
         .withColumn("shape", (F.col("file_no") % 3).cast("int")) \
         .withColumn("path", F.concat(F.lit("tasks/"), F.col("project"), F.lit("/"),
                                      F.col("file_no").cast("string"), F.lit(".yaml")))
    d = (deps.groupBy("project", F.col("child").alias("task_id"))
         .agg(F.array_sort(F.collect_list("parent")).alias("deps")))  # one task's parents
    # written: the files' bodies, their external dependencies and their update logs all start here
    t = settled(t.join(d, ["project", "task_id"], "left"))
    # phases in the order of their first tasks; the rows of a file (``per_file`` tasks) meet once, for all that follows
    w = Window.partitionBy("path").orderBy("min_seq", "label")
    kept = F.col("path").isNotNull() & F.col("label").isNotNull()
    named, t = t.repartition("path"), t.filter(kept)
    named = (named.withColumn("min_seq", F.min("seq").over(Window.partitionBy("path", "label")))
             .withColumn("k", F.dense_rank().over(w)).filter(kept))
    prio = X._lookup(F.col("priority"), PRIORITY_TEXT, "medium")
    stat = X._lookup(F.col("status"), STATUS_TEXT, "pending")
    deps_txt = F.concat(F.lit("["), F.array_join(F.transform(F.coalesce("deps", F.array().cast("array<string>")),
                                                             lambda x: _q(x)), ", "), F.lit("]"))
    no_name = F.col("label") == "not specified"
    name_line = F.when(no_name, F.concat(F.lit("description: "), _q(F.concat(F.lit("Work for "), F.col("task_id"))))) \
                 .otherwise(F.concat(F.lit("name: "), _q(F.col("title"))))

    id_line = F.concat(F.lit("id: "), _q(F.col("task_id")))
    fields = [name_line, F.concat(F.lit("priority: "), _q(prio)), F.concat(F.lit("status: "), _q(stat)),
              F.concat(F.lit("dependencies: "), deps_txt)]

    def item(dash: str, pad: str, with_id: bool) -> Column:
        """A YAML sequence item: first key after the dash, the rest indented."""
        body = ([id_line] if with_id else []) + fields
        return F.concat_ws("\n", F.concat(F.lit(dash), body[0]), *[F.concat(F.lit(pad), x) for x in body[1:]])

    phases_block = F.when(F.col("priority") == 3, item("      - ", "        ", False)) \
        .otherwise(item("      - ", "        ", True))
    flat_block = item("  - ", "    ", True)
    keyed_block = F.concat(F.lit("    "), F.col("task_id"), F.lit(":\n"),
                           F.concat_ws("\n", *[F.concat(F.lit("      "), x) for x in fields]))
    named = named.withColumn("tblock", F.when(F.col("shape") == 0, phases_block)
                     .when(F.col("shape") == 1, flat_block).otherwise(keyed_block))
    # phase sections (bounded by the tasks of one file)
    ph = named.groupBy("path", "project", "shape", "k", "label").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "tblock"))), lambda s: s["tblock"]), "\n")
        .alias("tasks_txt"))
    lab_title = F.initcap(F.col("label"))
    ph_txt = (F.when(F.col("shape") == 0,
                     F.concat(F.lit("  - name: "), _q(F.concat(F.lit("Phase "), F.col("k").cast("string"), F.lit(": "), lab_title)),
                              F.lit("\n    tasks:\n"), F.col("tasks_txt")))
              .when(F.col("shape") == 1, F.col("tasks_txt"))
              .otherwise(F.concat(F.lit("phase"), F.col("k").cast("string"), F.lit("_"), X.slugify(F.col("label")),
                                  F.lit(":\n  name: "), _q(F.col("label")), F.lit("\n  tasks:\n"), F.col("tasks_txt"))))
    doc = ph.groupBy("path", "project", "shape").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", ph_txt.alias("txt")))), lambda s: s["txt"]), "\n")
        .alias("body"))
    head = F.concat(F.lit("metadata:\n  project: "), _q(F.col("project")), F.lit("\n"))
    body = (F.when(F.col("shape") == 0, F.concat(F.lit("phases:\n"), F.col("body")))
            .when(F.col("shape") == 1, F.concat(F.lit("tasks:\n"), F.col("body")))
            .otherwise(F.col("body")))
    out = doc.select("path", "project", "shape", F.concat(head, body, F.lit("\n")).alias("text"))
    # every file lists its external dependencies (parents in other files); the phases layout also has an update log
    ext = (t.select("path", "project", "task_id", F.explode("deps").alias("parent"))
           .join(t.select("project", F.col("task_id").alias("parent"), F.col("path").alias("ppath")), ["project", "parent"])
           .filter(F.col("ppath") != F.col("path"))
           .groupBy("path", "ppath").agg(F.array_sort(F.collect_set("parent")).alias("ptasks"))
           .select("path", F.concat(F.lit("    - project: "), _q(F.regexp_extract("ppath", r"^tasks/([^/]+)/", 1)),
                                    F.lit("\n      location: "), _q(F.col("ppath")),
                                    F.lit('\n      purpose: "cross-file dependency"\n      tasks: ['),
                                    F.array_join(F.transform("ptasks", lambda x: _q(x)), ", "), F.lit("]")).alias("e"),
                   "ppath")
           .groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ppath", "e"))),
                                                         lambda s: s["e"]), "\n").alias("ext")))
    out = out.join(ext, "path", "left")
    if updated is not None:
        up = (t.filter((F.col("shape") == 0) & (F.col("status") == "closed"))
              .join(updated, ["project", "task_id"])
              .groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "task_id", "updated_on"))),
                                                            lambda s: F.concat(F.lit('  - "'), F.date_format(s["updated_on"], "yyyy-MM-dd"),
                                                                               F.lit(": closed "), s["task_id"], F.lit('"'))), "\n")
                                   .alias("upd")))
        out = out.join(up, "path", "left")
    else:
        out = out.withColumn("upd", F.lit(None).cast("string"))
    text = F.concat(F.col("text"),
                    F.when(F.col("ext").isNotNull(), F.concat(F.lit("dependencies:\n  external:\n"), F.col("ext"), F.lit("\n")))
                    .otherwise(F.lit("")),
                    F.when(F.col("upd").isNotNull(), F.concat(F.lit("updates:\n"), F.col("upd"), F.lit("\n")))
                    .otherwise(F.lit("")))
    return out.select("path", text.alias("text"))
