"""Log files and texts to records, and records to canonical events.

Files are read as the text source cuts them: in byte ranges that end at line ends, so a file of any size is read by many
tasks.  Each task puts the records of its ranges together as it reads; what a range cannot decide (its first lines, when
none of them opens a record, and its last record, which the next range may continue) is stitched from the few rows at the
borders.  Lines are never shuffled or ordered.

Defined results: empty lines are skipped, lines of blanks are not; bytes that are no UTF-8 become U+FFFD; a gzip file is
one range; a null text has no records; a record may span any number of ranges.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import matching
from ..functions import predicates as P
from ..functions import text as X
from ..storage import new_path, store

# File endings that are ingested, and those that are searched for signals.
LOG_FILES = r"\.(log|txt|json|out|gz)$"
TRIAGE_FILES = r"(?i)\.(log|txt|json|jsonl|out|gz)$"
# The starts of a record, anywhere in a line: ISO times, and two compact log formats.
RECORD_START = r"(?U)\d{4}-\d{2}-\d{2}[\sT]\d{2}:\d{2}:\d{2}|\d{6}\s+\d{6}|-\s+\d+\s+\d{4}\.\d{2}\.\d{2}"
# What ends a line of a text.
LINE_ENDS = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
FRAGMENT = "source_file string, range_start long, at long, raw string, head boolean, open boolean"
SMALL_RANGES = 1_000_000
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTING_TASKS = 4  # a core
ROW_END = "\x01"


def is_file(spark: SparkSession, path: str) -> bool:
    if any(c in path for c in "*?[{"):
        return False
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isFile()


def file_lines(spark: SparkSession, path: str | list[str], endings: str = LOG_FILES, empty: bool = False) -> DataFrame:
    """(source_file, range_start, line) of every log file below a folder, and of files named one by one; gzip is read as its
    text; hidden files are not.  Lines of a range follow each other in order; empty ones only if asked for."""
    paths = [path] if isinstance(path, str) else list(path)
    if not paths:
        raise ValueError("no log files named")
    named = [is_file(spark, p) for p in paths]

    def read(chosen):
        # folders are listed here; Spark's default is a task a folder up to 10,000, most of whose time is their start
        before = spark.conf.get(LISTING)
        spark.conf.set(LISTING, min(int(before), LISTING_TASKS * spark.sparkContext.defaultParallelism))
        try:
            rows = spark.read.option("recursiveFileLookup", True).text(chosen)
        finally:
            spark.conf.set(LISTING, before)
        return rows.select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("range_start"), F.make_valid_utf8("value").alias("line"))

    parts = []
    if folders := [p for p, f in zip(paths, named) if not f]:
        hidden = F.element_at(F.split("source_file", "/"), -1).startswith(".")
        parts.append(read(folders).where(F.col("source_file").rlike(endings) & ~hidden))
    if files := [p for p, f in zip(paths, named) if f]:
        parts.append(read(files))
    lines_ = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return lines_ if empty else lines_.where("line <> ''")


def lines(texts: DataFrame) -> DataFrame:
    """(source_file, range_start, line) of non-empty lines; a text is one range, whose lines follow each other in order."""
    one = texts.select("source_file", "text", F.monotonically_increasing_id().alias("range_start"))
    return one.select("source_file", "range_start", F.explode(F.split("text", LINE_ENDS)).alias("line")).where("line <> ''")


def audit_csv(line):
    """A line that looks like an audit CSV row."""
    return line.contains("system:") & (line.contains("ResponseStarted") | line.contains("ResponseComplete")) & (F.regexp_count(line, F.lit(",")) >= 10)


def braced(line):
    """What may be a JSON object: the whole line, else from its first brace to its last."""
    whole = F.trim(line).startswith("{") & F.trim(line).endswith("}")
    return F.when(line.contains("{") & line.contains("}"), F.when(whole, F.trim(line)).otherwise(F.regexp_extract(line, r"(?s)\{.*\}", 0)))


def checked(df: DataFrame, name: str, text) -> DataFrame:
    """Adds a text that is JSON, null if it is not.  A column of its own first: an expression used twice is evaluated twice."""
    return df.withColumn(name, text).withColumn(name, F.when(F.try_parse_json(name).isNotNull(), F.col(name)))


def fragments(lines_: DataFrame) -> DataFrame:
    """Records of each range, numbered from 0: JSON and audit lines stand alone, a line with a start mark opens a record,
    any other line continues the open one.

    head: no line of the range opened this record, so it may continue the one before the range; open: it is the range's
    last and may go on after it.
    """
    line = F.col("line")
    solo = F.coalesce(F.try_parse_json(braced(line)).isNotNull() | audit_csv(line), F.lit(False))
    marked = lines_.select("source_file", "range_start", "line", solo.alias("solo"))
    marked = marked.withColumn("starts", F.when(F.col("solo"), F.lit(False)).otherwise(line.rlike(RECORD_START)))
    names = [x.split()[0] for x in FRAGMENT.split(", ")]

    def assemble(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_())
        # the record that the lines to come may go on with: its range, number, lines, whether it is a head or stands alone
        key, at, held, head, closed = None, 0, [], False, False

        def batch(*columns):
            return pa.RecordBatch.from_arrays([pa.array(c, k) if isinstance(c, (list, np.ndarray)) else c.cast(k) for c, k in zip(columns, kinds)], names)

        def last(is_open):
            return batch([key[0]], [key[1]], [at], ["\n".join(held)], [head], [is_open and not closed])

        for b in batches:
            source, start, line, solo, starts = b.columns
            n = len(line)
            if not n:
                continue
            where, solo, starts = start.to_numpy(), solo.to_numpy(zero_copy_only=False), starts.to_numpy(zero_copy_only=False)
            fresh = np.empty(n, bool)
            fresh[0] = (source[0].as_py(), start[0].as_py()) != key
            fresh[1:] = (where[1:] != where[:-1]) | pc.not_equal(source.slice(1), source.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            opens = fresh | solo | starts
            opens[0] |= closed
            opens[1:] |= solo[:-1]
            first = np.flatnonzero(opens)
            goes_on = int(first[0]) if len(first) else n
            if goes_on:
                held.append("\n".join(line.slice(0, goes_on).to_pylist()))
            if not len(first):
                continue
            if key is not None:
                yield last(bool(fresh[first[0]]))
            # records are numbered from the one that is the first of its range
            places, heads = np.arange(len(first)), fresh[first] & ~solo[first] & ~starts[first]
            since = np.maximum.accumulate(np.where(fresh[first], places, -1))
            numbers = np.where(since < 0, at + 1 + places, places - since)
            ends = np.append(fresh[first[1:]] & ~solo[first[:-1]], False)
            whole = len(first) - 1
            if whole:
                lists = pa.ListArray if pa.types.is_string(line.type) else pa.LargeListArray
                texts = pc.binary_join(lists.from_arrays(pa.array(first, pa.int32() if lists is pa.ListArray else pa.int64()), line), "\n")
                rows = pa.array(first[:-1])
                yield batch(source.take(rows), start.take(rows), numbers[:-1], texts, heads[:-1], ends[:-1])
            tail = int(first[-1])
            key, at, head, closed = (source[tail].as_py(), start[tail].as_py()), int(numbers[-1]), bool(heads[-1]), bool(solo[tail])
            held = ["\n".join(line.slice(tail).to_pylist())]
        if key is not None:
            yield last(True)

    return marked.mapInArrow(assemble, FRAGMENT)


def records(texts: DataFrame) -> DataFrame:
    """(source_file, record_no, raw, json) of texts, each by itself."""
    found = fragments(lines(texts)).select("source_file", (F.col("at") + 1).alias("record_no"), "raw")
    return checked(found, "json", braced(F.col("raw")))


def sent(ranges: DataFrame) -> DataFrame:
    """Ranges to be joined: sent to all tasks up to a number that, at 128 MB a range, 100 TB have; beyond it dealt by range."""
    return F.broadcast(ranges) if ranges.count() <= SMALL_RANGES else ranges


def numbered_lines(lines_: DataFrame) -> DataFrame:
    """(source_file, line_no, line) of files read in ranges, all lines from 1."""

    def count(batches):
        import pyarrow as pa

        key, at = None, 0
        for b in batches:
            places = []
            for k in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                at = at + 1 if k == key else 1
                key = k
                places.append(at)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(places, pa.int64()), b.column(2)], ["source_file", "range_start", "at", "line"])

    found = store(lines_.select("source_file", "range_start", "line").mapInArrow(count, "source_file string, range_start long, at long, line string"), "lines")
    ranges = found.groupBy("source_file", "range_start").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("source_file").orderBy("range_start")) - F.col("n")
    ranges = sent(store(ranges.select("source_file", "range_start", before.alias("before")), "ranges"))
    return found.join(ranges, ["source_file", "range_start"]).select("source_file", (F.col("before") + F.col("at")).alias("line_no"), "line")


def file_records(lines_: DataFrame) -> DataFrame:
    """(source_file, record_no, raw, json) of files read in ranges; the same however they are cut.

    Stitched records are stored beside the others, in the place of their first piece, so that all are read as one table.
    """
    spark, path = lines_.sparkSession, new_path(lines_.sparkSession, "fragments")
    fragments(lines_).write.parquet(f"{path}/read")
    found = spark.read.schema(FRAGMENT).parquet(f"{path}/read")
    ranges = found.groupBy("source_file", "range_start").agg(F.count("*").alias("n"), F.bool_or("head").alias("has_head"), F.bool_or("open").alias("ends_open"))
    order = Window.partitionBy("source_file").orderBy("range_start")
    joins = F.col("has_head") & F.coalesce(F.lag("ends_open").over(order), F.lit(False))
    ranges = ranges.withColumn("joins", joins.cast("long"))
    opened = F.col("n") - F.col("joins")
    ranges = sent(store(ranges.select("source_file", "range_start", "joins", (F.sum(opened).over(order) - opened).alias("before")), "ranges"))

    def numbered(pieces):
        return pieces.join(ranges, ["source_file", "range_start"]).withColumn("record_no", F.col("before") + F.col("at") + 1 - F.col("joins"))

    border = F.col("open") | (F.col("head") & (F.col("joins") == 1))
    pieces = F.array_sort(F.collect_list(F.struct("range_start", "at", "raw")))
    stitched = numbered(found.where("open or head")).where(border).groupBy("source_file", "record_no").agg(pieces.alias("pieces"))
    place = [F.col("pieces")[0][c].alias(c) for c in ("range_start", "at")]
    stitched = stitched.select("source_file", *place, F.array_join(F.transform("pieces", lambda x: x["raw"]), "\n").alias("raw"), F.lit(False).alias("head"), F.lit(False).alias("open"))
    stitched.write.parquet(f"{path}/stitched")
    whole = numbered(spark.read.schema(FRAGMENT).parquet(f"{path}/read", f"{path}/stitched")).where(~border)
    return checked(whole.select("source_file", "record_no", "raw"), "json", braced(F.col("raw")))


# The fields that are read of a wrapped payload, and of an audit object.
PAYLOAD = """time string, t struct<`$date`:string>, s string, level string, error string, msg string, log string, method string, user_name string, caller string, ctx string, c string, path string, uri string, stream string,
attr struct<collection:string,db:string,topic:string,index:string>, kubernetes struct<labels:map<string,string>,container_name:string,pod_name:string,namespace_name:string>,
statusCode string, status string, status_code string, code string, responseStatus struct<code:string>, response struct<status:string,code:string>"""
AUDIT = "requestReceivedTimestamp string, user struct<username:string>, verb string, objectRef struct<resource:string>, requestURI string, stage string, responseStatus struct<code:string>"


def _at(struct: str, *names: str):
    """The first non-empty one of some fields."""
    return F.get(F.filter(F.array(*[F.col(f"{struct}.{n}") for n in names]), lambda v: v != ""), F.lit(0))


def with_payload(recs: DataFrame, raw, has_json) -> DataFrame:
    """Adds collector time and payload of a line `name: [time, {payload}]`."""
    array = F.when(has_json & F.trim(raw).rlike(r"^(all\.logs|asup\.error\.logs):"), F.regexp_extract(raw, r"(?s)\[.*", 0))
    d = checked(recs, "_array", array).withColumn("collector", F.get_json_object("_array", "$[0]")).withColumn("payload", F.get_json_object("_array", "$[1]"))
    return d.withColumn("payload", F.when(F.col("payload").startswith("{"), F.col("payload"))).drop("_array")


def events(recs: DataFrame) -> DataFrame:
    """Canonical events from records: wrapped payloads, else audit JSON, else a row of twelve comma-separated fields; then
    severity, family and texts."""
    raw = F.col("raw")
    has_json = F.col("json").isNotNull() & ~F.col("json").rlike(r"^\{\s*\}$")
    d = with_payload(recs, raw, has_json)
    d = d.withColumn("audit", F.when(has_json & F.col("payload").isNull(), F.col("json")))
    d = d.withColumn("p", F.from_json("payload", PAYLOAD)).withColumn("a", F.from_json("audit", AUDIT))
    # a field after the last one of the first line tells short rows from those that end in empty fields
    first = F.concat(F.regexp_extract(F.trim(raw), r"^[^\n]*", 0), F.lit("," + ROW_END))
    fields = [f"c{i}" for i in range(12)]
    row = F.from_csv(first, ", ".join(f"{c} string" for c in fields), {"escape": '"'})
    d = d.withColumn("row", F.when(F.col("payload").isNull() & F.col("audit").isNull() & (F.regexp_count(raw, F.lit(",")) >= 11), row))
    short = F.array_contains(F.array(*[F.coalesce(f"row.{c}", F.lit("")) for c in fields]), ROW_END)
    d = d.withColumn("row", F.when(~short, F.col("row")))
    p = lambda *names: _at("p", *names)
    a = lambda *names: _at("a", *names)
    csv = lambda i: F.nullif(F.trim(F.col(f"row.c{i}")), F.lit(""))
    label = lambda n: F.nullif(F.try_element_at("p.kubernetes.labels", F.lit(n)), F.lit(""))
    wrapped = F.col("payload").isNotNull()
    told = lambda *names: F.when(wrapped, F.concat_ws(" ", *[F.coalesce(p(n), F.lit("")) for n in names]))
    # what several columns are made of is a column first, so that it is evaluated once
    d = d.withColumn("message", told("error", "msg", "log")).withColumn("spoken", told("msg", "log")).withColumn("keys", F.json_object_keys("payload"))
    message, spoken = F.col("message"), F.col("spoken")
    service = F.coalesce(label("app.kubernetes.io/name"), label("app"), p("kubernetes.container_name", "kubernetes.pod_name"))
    d = d.withColumn("service", service).withColumn("user", F.coalesce(a("user.username"), csv(2)))
    d = d.withColumn("actor", p("user_name", "caller", "ctx", "kubernetes.container_name"))
    d = d.withColumn("actor", F.coalesce(X.identity("actor"), X.identity("service"))).withColumn("user", X.identity("user"))
    service, actor, user = F.col("service"), F.col("actor"), F.col("user")
    whole = lambda c: F.when(c.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(c).try_cast("int"))
    stamped = F.nullif(F.col("p.t")["$date"], F.lit(""))
    zoned = F.when(csv(1).contains("T") & csv(1).endswith("Z"), csv(1))
    code = F.coalesce(*[X.http_code(p(n)) for n in ("statusCode", "status", "status_code", "code", "responseStatus.code", "response.status", "response.code")], X.code_in_text(message), whole(a("responseStatus.code")), whole(csv(11)))
    letters = F.create_map(*[F.lit(x) for x in ("F", "FATAL", "E", "ERROR", "W", "WARN", "I", "INFO", "D", "DEBUG", "T", "TRACE")])
    level = F.when(F.upper(p("level")).isin("FATAL", "ERROR", "WARN", "INFO", "DEBUG", "TRACE"), F.upper(p("level")))
    severity = F.coalesce(F.when(p("s").isNotNull(), F.try_element_at(letters, F.upper(p("s")))).otherwise(level), X.severity_in_text(spoken))
    d = d.withColumn("host", X.dependency_host(message))
    host = F.col("host")
    e = d.select(
        F.sha2(F.concat_ws("|", "source_file", F.col("record_no").cast("string")), 256).alias("event_id"),
        "source_file",
        "record_no",
        F.lit("log").alias("source_type"),
        F.coalesce(p("time"), stamped, X.epoch_iso("collector"), a("requestReceivedTimestamp"), zoned, X.iso_timestamp(raw)).alias("timestamp"),
        severity.alias("told"),
        F.coalesce(service, user).alias("service"),
        F.coalesce(actor, user).alias("actor"),
        F.coalesce(F.lower(p("method")), X.verb_in_text(spoken), a("verb"), csv(3)).alias("verb"),
        F.coalesce(p("attr.collection", "attr.db", "attr.topic", "attr.index", "kubernetes.pod_name", "kubernetes.namespace_name", "c"), a("objectRef.resource"), csv(4)).alias("resource"),
        F.coalesce(p("path", "uri"), F.when(wrapped, X.path_in_text(F.coalesce(p("log"), p("msg")))), a("requestURI"), csv(8)).alias("path"),
        F.lower(F.coalesce(p("stream"), a("stage"), csv(10))).alias("stage"),
        code.alias("response_code"),
        "message",
        F.element_at(F.split(host, r"\."), 1).alias("target"),
        host.alias("target_fqdn"),
        F.when(wrapped, F.regexp_extract(raw, r"^\s*(all\.logs|asup\.error\.logs):", 1)).alias("source_subtype"),
        X.payload_type("payload", "keys").alias("inner_type"),
        F.col("collector").alias("collector_ts"),
        F.col("raw").alias("raw_text"),
    )
    e = e.withColumn("_found", matching.labels(F.col("message"), X.actor_role("actor"), F.col("raw_text")))
    e = e.withColumn("failure_hint", F.col("_found.hint")).withColumn("_component", F.col("_found.component")).drop("_found", "message")
    e = e.withColumn("http_class", F.when(F.col("response_code").isNotNull(), F.concat(F.floor(F.col("response_code") / 100).cast("string"), F.lit("xx"))))
    wrapped = F.col("source_subtype").isNotNull()
    own = F.when(F.col("http_class").isin("4xx", "5xx"), "failure").when(F.col("http_class").isNotNull(), "normal").when(F.col("told").isin("ERROR", "FATAL") | F.col("failure_hint").isNotNull(), "failure").when(F.col("told") == "WARN", "warning").otherwise("unknown")
    e = e.withColumn("severity", F.coalesce("told", P.severity_of(F.col("response_code"), F.col("raw_text"))))
    e = e.withColumn("status_family", F.when(wrapped, own).otherwise(P.family_of(F.col("response_code"), F.col("severity"))))
    where = F.when(F.col("target").isNotNull(), "dependency_target").when(F.col("status_family") == "failure", "source_service")
    e = e.withColumn("failure_location", F.when(wrapped, where)).withColumn("causal_confidence_tier", F.when(F.col("failure_location") == "dependency_target", "observed").when(F.col("failure_location").isNotNull(), "likely"))
    told = ("source_file", "record_no", "source_subtype", "inner_type", "collector_ts", "target_fqdn", "failure_location", "causal_confidence_tier")
    e = e.withColumn("structured_fields", F.struct(*told, F.col("told").alias("severity_hint"), F.col("target").alias("target_dependency_service")))
    e = e.withColumn("normalized_text", X.normalized("raw_text")).withColumn("redactions", X.redactions("raw_text"))
    e = e.withColumn("embedding_text", X.embedding_text("service", "severity", "verb", "resource", "http_class"))
    return enrich(e.drop("told"))


def enrich(e: DataFrame) -> DataFrame:
    """Adds the semantic struct and the signature; ``_component`` is the component found."""
    code = F.col("response_code")
    e = e.withColumn("_m", P.failure_mode(code, F.col("status_family"), F.col("failure_hint")))
    semantic = F.struct(F.col("_component").alias("component"), X.component_domain("_component").alias("domain"), "actor", F.col("verb").alias("operation"), "resource", P.status_class(code).alias("status_class"), F.col("_m").alias("failure_mode"))
    return e.withColumn("semantic", semantic).withColumn("failure_mode", F.col("_m")).withColumn("signature", X.signature("_component", "verb", "resource", "_m")).drop("_component", "_m")


def ingest(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Files to canonical events."""
    return events(file_records(file_lines(spark, path)))
