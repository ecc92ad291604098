"""Readers and writers of a corpus tree: <root>/<collection>/docs/<slug>/{manifest.json, figures.json, sections/*.md}.

All listing and reading is Spark's: paths may be in any store it knows. Unreadable files stay as rows with null
content; they are counted, never dropped.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscan.functions import text as X

from . import schemas as S


def _exists(spark: SparkSession, glob: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(glob)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    return found is not None and len(found) > 0


BYTES = "path string, modificationTime timestamp, length long, content binary"


def _bytes(spark: SparkSession, root: str, tail: str, tries: tuple[str, ...] = ("", "*/")) -> DataFrame:
    """Files under a root that is a collection itself, or under its folders; none: an empty table. Errors of reading are errors."""
    globs = [g for g in (f"{root.rstrip('/')}/{t}{tail}" for t in tries) if _exists(spark, g)]
    return spark.read.format("binaryFile").load(globs[:1]) if globs else spark.createDataFrame([], BYTES)


def _place(path: str = "path"):
    """collection folder and slug of a file under docs/."""
    return F.regexp_extract(path, r"([^/]+)/docs/[^/]+/", 1).alias("folder"), F.regexp_extract(path, r"/docs/([^/]+)/", 1).alias("slug")


def _decoded(content: str = "content"):
    """Text of UTF-8 bytes without a byte order mark; null where they aren't UTF-8."""
    text = F.when(F.is_valid_utf8(F.col(content).cast("string")), F.col(content).cast("string"))
    return F.regexp_replace(text, "^﻿", "")


def collections(spark: SparkSession, root: str) -> DataFrame:
    """(folder, collection, n_documents) of folders with a document in docs/."""
    docs = manifests(spark, root)
    return docs.groupBy("folder", "collection").agg(F.count("*").alias("n_documents"))


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """One row a document folder with its manifest's fields; `bad` where it isn't a JSON object. The folder's name is the slug."""
    files = _bytes(spark, root, "docs/*/manifest.json").select("path", *_place(), _decoded().alias("text"))
    files = files.filter(~X.skipped_name("slug"))
    m = F.from_json("text", S.MANIFEST, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    return files.select("path", "folder", X.slug("folder", default="corpus").alias("collection"), F.col("slug").alias("own_slug"), m.alias("m")).select("path", "folder", "collection", F.col("own_slug").alias("slug"), F.col("m.slug").alias("manifest_slug"), *[f"m.{c}" for c in ("source_pdf", "title", "page_count", "doc_id", "version", "version_and_later", "extractor", "toc", "attribution", "sections", "converter")], (F.col("m").isNull() | F.col("m._bad").isNotNull()).alias("bad"))


def section_files(spark: SparkSession, root: str) -> DataFrame:
    """(collection, slug, file, text): text is null where the bytes are not UTF-8."""
    files = _bytes(spark, root, "docs/*/sections/*.md").select("path", *_place(), _decoded().alias("text"))
    return files.filter(~X.skipped_name("slug")).select(X.slug("folder", default="corpus").alias("collection"), "slug", F.regexp_extract("path", r"(sections/[^/]+)$", 1).alias("file"), "text")


def figures(spark: SparkSession, root: str) -> DataFrame:
    """(collection, slug, bad, figure fields) of every figure; a file that can't be read is one row with bad set."""
    files = _bytes(spark, root, "docs/*/figures.json").select(*_place(), F.from_json(_decoded(), S.FIGURES, {"columnNameOfCorruptRecord": "_bad"}).alias("f"))
    return files.select(X.slug("folder", default="corpus").alias("collection"), "slug", (F.col("f").isNull() | F.col("f._bad").isNotNull()).alias("bad"), F.explode_outer("f.figures").alias("x")).select("collection", "slug", "bad", "x.*")


def chunks(spark: SparkSession, root: str, with_crumb: bool = True) -> DataFrame:
    """The sections of every readable manifest with their texts: (collection, slug, ord, file, title, heading, entity, breadcrumb, body, level, pages, chars, noise)."""
    s = manifests(spark, root).filter("not bad").select("collection", "slug", "title", F.posexplode("sections").alias("ord", "s")).select("collection", "slug", "title", "ord", "s.*")
    met = s.join(section_files(spark, root), ["collection", "slug", "file"], "left")
    heading = X.clean_heading(F.coalesce("heading", F.lit("")))
    body = F.col("text") if with_crumb else X.without_crumb("text", "breadcrumb")
    return met.select("collection", "slug", "ord", "file", "title", heading.alias("heading"), F.coalesce("entity", "command").alias("entity"), "breadcrumb", body.alias("body"), "level", "page_start", "page_end", F.length("text").alias("chars"), X.is_noise(heading, F.coalesce("text", F.lit(""))).alias("noise"))


def pins(spark: SparkSession, root: str) -> DataFrame:
    """(collection, doc_id, version) of every current_versions.json; an entry that isn't text is an error."""
    rows = _bytes(spark, root, "current_versions.json").select(F.regexp_extract("path", r"([^/]+)/current_versions\.json$", 1).alias("folder"), F.from_json(_decoded(), S.PINS).alias("m"))
    rows = rows.withColumn("m", F.when(F.col("m").isNull(), F.raise_error(F.concat(F.lit("pins can't be read: "), "folder"))).otherwise(F.col("m")))
    return rows.select(X.slug("folder", default="corpus").alias("collection"), F.explode("m").alias("doc_id", "version"))


def questions(spark: SparkSession, path: str) -> DataFrame:
    """Questions of a JSON-lines file; blank lines and // lines are skipped; one without question or answers is an error."""
    rows = spark.read.text(path).filter(~F.col("value").rlike(r"^\s*(//|$)")).select(F.from_json("value", S.QUESTION).alias("q"), "value").select("q.*", "value")
    bad = F.col("question").isNull() | F.col("answers").isNull()
    return rows.withColumn("question", F.when(bad, F.raise_error(F.concat(F.lit("no question or answers: "), "value"))).otherwise(F.col("question"))).drop("value")


def calls(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Calls of a log; lines that are no call have `bad` set and stay, so they can be counted."""
    reader = spark.readStream if streaming else spark.read
    rows = reader.text(path).select(F.from_json("value", S.CALL).alias("c")).select("c.*")
    return rows.withColumn("bad", F.col("tool").isNull())


def superseded(spark: SparkSession, root: str) -> DataFrame:
    """(collection, file, superseded_by) of every superseded.json; a list that can't be read is an error, an entry that lacks a field stays with null."""
    rows = _bytes(spark, root, "superseded.json").select(F.regexp_extract("path", r"([^/]+)/superseded\.json$", 1).alias("folder"), F.from_json(_decoded(), S.SUPERSEDED).alias("m"))
    rows = rows.withColumn("m", F.when(F.col("m").isNull(), F.raise_error(F.concat(F.lit("superseded.json can't be read: "), "folder"))).otherwise(F.col("m")))
    return rows.select(X.slug("folder", default="corpus").alias("collection"), F.inline("m"))


DECISIONS = "map<string, struct<title:string,doc_id:string,version:string,slug:string,skip:boolean>>"


def decisions(spark: SparkSession, path: str) -> DataFrame:
    """(file, title, doc_id, version, slug, skip) of a file of decisions about incoming PDFs; other keys, and values of another kind, are errors."""
    raw = spark.read.text(path, wholetext=True)
    known = F.array(*[F.lit(k) for k in ("title", "doc_id", "version", "slug", "skip")])
    keys = F.from_json("value", "map<string, map<string, string>>")
    rows = raw.select(F.from_json("value", DECISIONS, {"mode": "FAILFAST"}).alias("m"), keys.alias("k"))
    odd = F.exists(F.map_values("k"), lambda v: F.size(F.array_except(F.map_keys(v), known)) > 0)
    checked = rows.select(F.when(F.col("m").isNull() | F.coalesce(odd, F.lit(True)), F.raise_error(F.lit("decisions can't be read"))).otherwise(F.col("m")).alias("m"))
    return checked.select(F.explode("m").alias("file", "d")).select("file", "d.*")


def unused_decisions(decisions_: DataFrame, pdfs: DataFrame) -> DataFrame:
    """Decisions about files that aren't there."""
    return decisions_.join(pdfs.select(F.col("name").alias("file")).distinct(), "file", "left_anti").select("file")


def labels(spark: SparkSession, root: str) -> DataFrame:
    """(folder, label): what a collection calls itself in vendor.json, else its folder's name."""
    said = _bytes(spark, root, "vendor.json").select(F.regexp_extract("path", r"([^/]+)/vendor\.json$", 1).alias("folder"), F.trim(F.get_json_object(_decoded(), "$.label")).alias("label"))
    return manifests(spark, root).select("folder").distinct().join(said, "folder", "left").select("folder", F.coalesce(F.nullif("label", F.lit("")), "folder").alias("label"))


def source_pdfs(spark: SparkSession, root: str) -> DataFrame:
    """(folder, place, name, size, sha256) of PDFs in source/, the collection's folder and inbox/; the suffix in any case."""
    parts = []
    for place, tail in (("source", "source/*"), ("root", "*.[pP][dD][fF]"), ("inbox", "inbox/*")):
        files = _bytes(spark, root, tail).filter(F.lower("path").endswith(".pdf"))
        folder = F.element_at(F.split("path", "/"), F.lit(-2 if place == "root" else -3))
        parts.append(files.select(folder.alias("folder"), F.lit(place).alias("place"), F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def source_of(manifests_: DataFrame, pdfs: DataFrame) -> DataFrame:
    """manifests (folder, slug, source_pdf) with place: where the PDF lies, source/ before the folder itself; the inbox is no source."""
    own = pdfs.filter("place <> 'inbox'").groupBy("folder", F.col("name").alias("source_pdf")).agg(F.max("place").alias("place"))  # "source" is after "root"
    return manifests_.join(own, ["folder", "source_pdf"], "left")


def waiting(spark: SparkSession, root: str) -> DataFrame:
    """(folder, n_pdfs) of folders that have PDFs in their inbox and no documents yet."""
    found = source_pdfs(spark, root).filter("place = 'inbox'").groupBy("folder").agg(F.count("*").alias("n_pdfs"))
    return found.join(collections(spark, root).select("folder"), "folder", "left_anti")


def sources(spark: SparkSession, root: str) -> DataFrame:
    """(path, size, modified, sha256) of manifests, figure lists and pins, relative to the root."""
    every = _bytes(spark, root, "docs/*/manifest.json")
    for tail in ("docs/*/figures.json", "current_versions.json"):
        every = every.unionByName(_bytes(spark, root, tail))
    at = F.regexp_extract("path", r"([^/]+/(?:docs/.*|current_versions\.json))$", 1)
    return every.select(at.alias("path"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("sha256"))


# Sinks.


def _point(spark: SparkSession, out: str, version: str) -> None:
    """CURRENT says version from now on: a new file takes its place in one step, which stores do without a moment between."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    new, now = jvm.org.apache.hadoop.fs.Path(f"{version}.pointer"), jvm.org.apache.hadoop.fs.Path(f"{out}/CURRENT")
    stream = now.getFileSystem(conf).create(new, True)
    stream.write(bytearray(version.encode()))
    stream.close()
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(now.getFileSystem(conf).getUri(), conf)
    context.rename(context.makeQualified(new), context.makeQualified(now), over)


def write_index(spark: SparkSession, tables: dict[str, DataFrame], out: str) -> str:
    """Write all tables under a new version of `out`, then point CURRENT at it: readers see the old index or the new one, at any moment.

    If a table can't be written, the new version goes and CURRENT stays. The version before is kept: see roll_back.
    """
    version = f"{out}/v-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(version)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        for name, df in tables.items():
            writer = df.write.mode("errorifexists")
            if name == "chunks" and "collection" in df.columns:
                writer = writer.partitionBy("collection")
            writer.parquet(f"{version}/{name}")
        before = current_index(spark, out) if _exists(spark, f"{out}/CURRENT") else ""
        spark.createDataFrame([(before,)], "value string").coalesce(1).write.text(f"{version}/BEFORE")
    except Exception:
        fs.delete(at, True)
        raise
    _point(spark, out, version)
    return version


def roll_back(spark: SparkSession, out: str) -> str:
    """Point CURRENT at the version before; an error if there is none."""
    before = spark.read.text(f"{current_index(spark, out)}/BEFORE").first()
    if before is None or not before.value:
        raise ValueError("no index before this one")
    _point(spark, out, before.value)
    return before.value


def current_index(spark: SparkSession, out: str) -> str:
    return spark.read.text(f"{out}/CURRENT").first().value


def read_index(spark: SparkSession, out: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{current_index(spark, out)}/{name}")


def export_chunks(chunks_: DataFrame, documents: DataFrame, out: str, current_only: bool = False) -> None:
    """One JSON object a chunk, id collection/slug/file; nothing is written if a text is missing."""
    if not chunks_.filter("body is null").isEmpty():
        raise ValueError("chunks without text")
    docs = documents.filter("is_current") if current_only else documents
    rows = chunks_.drop("title").join(docs.select("collection", "slug", "doc_id", "version", "version_and_later", "is_current", "title"), ["collection", "slug"])
    rows.select(F.concat_ws("/", "collection", "slug", "file").alias("id"), "collection", "slug", "doc_id", "version", "version_and_later", "is_current", "title", "file", "ord", "heading", "breadcrumb", "page_start", "page_end", "entity", F.col("body").alias("text")).write.mode("overwrite").json(out)


def clipped(args, most: int = 2000):
    """Arguments of a call with long values cut."""
    return F.transform_values(args, lambda _, v: F.when(F.length(v) > most, F.concat(F.left(v, F.lit(most)), F.lit("…"))).otherwise(v))


def append_calls(calls_: DataFrame, path: str) -> None:
    calls_.withColumn("args", clipped("args")).write.mode("append").json(path)


def next_question_id(questions_: DataFrame) -> str:
    n = questions_.select(F.max(F.nullif(F.regexp_extract("id", r"^r(\d+)$", 1), F.lit("")).cast("int")).alias("n")).first().n
    return f"r{(n or 0) + 1:02d}"


def write_document(spark: SparkSession, manifest: DataFrame, sections: DataFrame, out: str) -> None:
    """One document of a converter: manifest.json, full.md and sections/NNNN-slug.md. sections: (ord, heading, breadcrumb, body, …); their files are named here.

    One document's sections go through the driver one by one, to the store's own interface: a converter makes one document at a time.
    """
    named = sections.withColumn("file", F.concat(F.lit("sections/"), F.lpad(F.col("ord").cast("string"), 4, "0"), F.lit("-"), X.slug(F.regexp_replace("heading", "[*_`]", ""), 60, "section"), F.lit(".md")))
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(out).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def put(name: str, text: str) -> None:
        stream = fs.create(jvm.org.apache.hadoop.fs.Path(f"{out}/{name}"), True)
        stream.write(bytearray(text.encode()))
        stream.close()

    whole = []
    for row in named.orderBy("ord").toLocalIterator():
        put(row.file, row.body)
        whole.append(row.body)
    put("full.md", "\n\n".join(whole))
    fields = [c for c in named.columns if c not in ("body", "ord")]
    listed = named.agg(F.transform(F.sort_array(F.collect_list(F.struct("ord", F.struct(*fields).alias("s")))), lambda x: x.s).alias("sections"))
    put("manifest.json", manifest.crossJoin(listed).select(F.to_json(F.struct("*")).alias("j")).first().j)


def catalog(documents: DataFrame) -> DataFrame:
    """(collection, catalog): docs/index.json of each collection. An edition of which it is undecided whether it is current stops it: nothing is written then."""
    ok = documents.withColumn("is_current", F.when(F.col("is_current").isNull(), F.raise_error(F.concat(F.lit("editions can't be told apart: "), "doc_id"))).otherwise(F.col("is_current")))
    rows = F.sort_array(F.collect_list(F.struct(*["slug", *[c for c in documents.columns if c not in ("slug", "collection")]])))
    return ok.groupBy("collection").agg(F.to_json(rows).alias("catalog"))


def converter(script: str, extractor: str, version: str, owns_breadcrumbs: bool):
    """What made a document, as a column: script, extractor with its version, time, and whether its breadcrumbs are its own."""
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return F.struct(F.lit(script).alias("script"), F.lit(extractor).alias("extractor"), F.lit(version).alias("extractor_version"), now.alias("converted_at"), F.lit(owns_breadcrumbs).alias("owns_breadcrumbs"))


def append_questions(spark: SparkSession, questions_: DataFrame, path: str) -> None:
    """Questions with ids that go on from those there are: r01, r02, …; each call adds files of whole lines, so no line is ever broken."""
    from pyspark.sql import Window

    last = int(next_question_id(questions(spark, path))[1:]) - 1 if _exists(spark, path) else 0
    n = F.row_number().over(Window.orderBy("question")) + last
    questions_.withColumn("id", F.concat(F.lit("r"), F.when(n < 10, F.lpad(n.cast("string"), 2, "0")).otherwise(n.cast("string")))).write.mode("append").json(path)


def write_run(summary: DataFrame, results: DataFrame, out: str, meta: dict[str, str]) -> None:
    """An evaluation run: its rates, its results and how it was made, as JSON lines under one folder."""
    summary.write.json(f"{out}/summary")
    results.write.json(f"{out}/results")
    summary.sparkSession.createDataFrame([meta], "map<string, string>").toDF("meta").write.json(f"{out}/meta")


def filed_name(names: DataFrame, filed: DataFrame) -> DataFrame:
    """names (folder, name, version, sha256) with as_name and twin: a PDF takes its name if it is free, else the name with its release, else with a number; a file of the same bytes is there already."""
    twin = filed.select("folder", "sha256", F.col("name").alias("twin")).groupBy("folder", "sha256").agg(F.min("twin").alias("twin"))
    taken = filed.groupBy("folder").agg(F.collect_set(F.lower("name")).alias("_taken"))
    met = names.join(twin, ["folder", "sha256"], "left").join(taken, "folder", "left")
    stem = F.regexp_replace("name", r"(?i)\.pdf$", "")
    versioned = F.concat(stem, F.lit("-"), X.slug("version"), F.lit(".pdf"))
    free = lambda n: ~F.array_contains(F.coalesce("_taken", F.array().cast("array<string>")), F.lower(n))
    numbered = F.array_min(F.filter(F.sequence(F.lit(2), F.lit(99)), lambda k: free(F.concat(stem, F.lit("-"), k.cast("string"), F.lit(".pdf")))))
    own = F.when(F.col("twin").isNotNull(), F.col("twin")).when(free(F.col("name")), F.col("name")).when((F.coalesce("version", F.lit("")) != "") & free(versioned), versioned).otherwise(F.concat(stem, F.lit("-"), numbered.cast("string"), F.lit(".pdf")))
    return met.withColumn("as_name", own).drop("_taken")
