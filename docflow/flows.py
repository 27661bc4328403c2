"""The three flows of the original, end to end, as DataFrame functions.

Each flow takes DataFrames (from ``sources`` or tables) and returns the
records to write and the ledger lines to append; the caller writes them with
``sinks`` (or runs the flow inside ``streaming.incremental`` per micro-batch).

    extract:   manifest lines -> quota per site -> not yet extracted -> blocks,
               title, text, counts, keyword flag            (S3, A1, J1, X2-X4, F1, K1)
    translate: extracted records -> not yet translated -> newest first, quota
               per site -> status cascade -> U1 -> records   (J1, A5, A1, F3-F8, U1, K2)
    index:     translated records ⋈ URL -> newest-version and first-version
               tables                                        (K8, K6, K7)
    classify:  ja ok ⋉ en ok ⋉ extracted ▷ classified -> scores (J2, U2-U4, K3)
    sentiment: classified JSON lines ▷ scored -> title scores     (S11, J3, U3)
    posts:     post list -> not yet translated -> first and last n -> U1 (A6, U1)

Loop forms: ``extract_stream``, ``translate_stream`` and ``posts_stream`` run
one poll or keep polling; every poll works on its whole window minus the
ledger (see ``streaming.incremental``).  ``read_posts`` reads post pages and
their language sidecars named in manifests.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow import constants as K
from docflow.functions.text import keyword_flag
from docflow.operators import ledger as L
from docflow.functions.paths import feature_key, page_parts, tweet_parts
from docflow.operators.latest import first_version, index_record, index_records, latest_version
from docflow.operators.pages import page_features, prepend_h1
from docflow.operators.routing import source_lang, status_cascade
from docflow.functions.paths import with_suffix
from docflow.operators.scoring import enrich
from docflow.operators.translate import TranslateFn, passthrough, post_text, translate_items, translate_posts
from docflow.sinks.tables import (append_ledger, next_batch, quarantine, read_if_exists, write_extracted,
                                  write_hourly_manifest, write_translated)
from docflow.sources.files import classified_view, json_field, read_jsonl, read_named_files
from docflow.sources.manifests import recent_pages, recent_posts
from docflow.streaming.incremental import run_polls


def extract_flow(lines: DataFrame, pages: DataFrame | None = None, ledger: DataFrame | None = None,
                 quota: int = K.EXTRACT_SITE_QUOTA, keywords=K.COVID_KEYWORDS,
                 h1_sites=K.H1_PREPEND_SITES) -> tuple[DataFrame, DataFrame]:
    """``lines``: from ``sources.manifests.recent_pages`` (page_path, region,
    site, ordinal).  ``pages``: (file_path, mtime, html), e.g. from
    ``sources.files.scan_pages``; None reads just the listed files
    (``sources.files.read_named_files``).  ``ledger``: earlier extract lines
    (page_path).  The quota counts lines per region and site, before the
    ledger is consulted, as the original did (Q7).  Returns (records, ledger
    lines)."""
    todo = L.site_quota(lines, ["region", "site"], ["ordinal"], quota).drop("rank")
    todo = todo.dropDuplicates(["page_path"])
    if ledger is not None:
        todo = L.unprocessed(todo, ledger, "page_path")
    if pages is None:
        got = read_named_files(todo.select("page_path", "region", "site")) \
            .withColumn("mtime", F.timestamp_seconds("mtime_s")).drop("mtime_s")
    else:
        src = pages.select(F.col("file_path").alias("page_path"), "mtime", "html")
        got = todo.select("page_path", "region", "site").join(src, "page_path", "left")
    joined = got.filter(F.col("html").isNotNull())
    # region, site and mtime ride along: no join back, so no second file read
    f = page_features(joined, key="page_path", url=None, keep=("region", "site", "mtime"),
                      features=["title", "text", "content_num", "link_num", "first_h1"])
    f = prepend_h1(f, sites=h1_sites)
    rec = f.select("page_path", "region", "site", "mtime", "title", "text", "content_num", "link_num",
                   keyword_flag("text", keywords).alias("keyword_flag"))
    # Every item taken gets a ledger line: 0 extracted, 4 file missing or
    # unreadable (the original logged those and never retried them).  Built
    # from the items and the records (which a caller may persist), so the
    # page files are not read a second time.
    ok = rec.select("page_path", F.lit(True).alias("_ok"))
    led = todo.select("page_path").join(ok, "page_path", "left").select(
        "page_path", F.when(F.col("_ok"), F.lit(K.STATUS_OK)).otherwise(F.lit(K.STATUS_MISSING_FILES)).alias("status"))
    return rec, led


def translate_flow(records: DataFrame, ledger: DataFrame | None, to_lang: str,
                   quota: int = K.TRANSLATE_SITE_QUOTA, translate_fn: TranslateFn = passthrough,
                   memory: DataFrame | None = None, lang_file: str | None = None,
                   done: DataFrame | None = None, retry_status=None, memory_out: str | None = None,
                   lang_sidecars: bool = False, batch_id: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``records``: extraction records (page_path, region, site, mtime, text,
    content_num, link_num, keyword_flag[, lang file column]).  Newest first,
    at most ``quota`` per region and site after the ledger is consulted (Q7);
    then the status cascade and the translation.  Both choices are made on
    the narrow columns, and texts are fetched for the chosen rows only.
    ``done``: items whose target already exists (status 5).  ``memory_out``:
    where new part translations are kept for later runs.  ``lang_sidecars``:
    a page's ``.lang`` file, if there is one, overrides its region's
    language.  ``batch_id`` adds ``arrival``, the order of writes.  Returns
    (translated, ledger lines).

    Because the quota comes after the ledger, items left over in one run are
    taken by a later one; so this runs over the whole extracted table.
    ``retry_status`` (e.g. {3, 8}): items whose ledger lines all carry
    those codes are tried again (the original never retried)."""
    todo = records.select("page_path", "region", "site", "mtime")
    if ledger is not None:
        todo = L.unprocessed(todo, ledger, "page_path", retry_status=retry_status)
    chosen = L.site_quota(todo, ["region", "site"], [F.col("mtime").desc(), F.col("page_path").desc()], quota).select("page_path")
    todo = records.join(chosen, "page_path", "left_semi")
    if lang_sidecars:
        lang_file = "_lang"
        todo = read_named_files(todo.withColumn("_lang_path", with_suffix("page_path", ".lang")), "_lang_path", "_lang", "_lang_mtime")
        todo = todo.withColumn("_lang", F.regexp_replace("_lang", r"\A\s+|\s+\z", "")).drop("_lang_path", "_lang_mtime")
    todo = todo.withColumn("src_lang", source_lang("region", lang_file)).withColumn("to_lang", F.lit(to_lang))
    exists = None
    if done is not None:
        d = done.select(F.col("page_path").alias("_d")).distinct().withColumn("_done", F.lit(True))
        todo = todo.join(d, todo["page_path"] == d["_d"], "left").drop("_d")
        exists = F.coalesce(F.col("_done"), F.lit(False))
    st = status_cascade(src_lang="src_lang", to_lang="to_lang",
                        has_files=F.col("text").isNotNull() & F.col("content_num").isNotNull(),
                        keyword_hit=F.coalesce(F.col("keyword_flag"), F.lit(False)),
                        content_num="content_num", link_num="link_num",
                        n_lines=F.size(F.split("text", "\n", -1)), text_len=F.length("text"),
                        region="region", exists=exists)
    items = todo.withColumn("status", st)
    # region, site and mtime ride along (no join back to the items)
    out = translate_items(items, "page_path", translate_fn=translate_fn, memory=memory,
                          keep=("region", "site", "mtime"), memory_out=memory_out)
    if batch_id is not None:
        out = out.withColumn("arrival", arrival_order("page_path", batch_id))
    led = out.select("page_path", "region", "status", "to_lang")
    return out, led


def arrival_order(key: str, batch_id: int):
    """Order of writes as a long: by run, and within one by a hash of the
    item (a repeated run gives the same order)."""
    return F.lit(batch_id).cast("long") * (1 << 31) + F.pmod(F.xxhash64(key), F.lit(1 << 31))


def index_flow(translated: DataFrame, urls: DataFrame, root: str, arrival: str = "arrival",
               history: DataFrame | None = None, tz: str = "UTC") -> tuple[DataFrame, DataFrame, DataFrame]:
    """``translated``: (page_path, to_lang, status, translated, ``arrival``)
    where ``arrival`` orders writes (e.g. batch id); ``urls``:
    (page_path, url).  Records need a URL and a text (K8); each becomes the
    original's index document (``latest.index_record``), keyed by
    record_id = region/site/path/name and the target language; ``history``
    holds earlier records.  Returns (newest-version table, first-version
    table, skipped)."""
    ok = translated.filter((F.col("status") == K.STATUS_OK) & F.col("translated").isNotNull())
    # ids come from the translated text file's name (``<name>.txt``), as in the original
    ok = ok.select("page_path", "to_lang", "translated", F.col(arrival).alias("arrival"),
                   page_parts(with_suffix("page_path", ".txt"), root, tz).alias("_p"))
    rec, skipped = index_records(ok, urls, None, "page_path")
    # a path too short for an id is skipped, not merged with others like it
    skipped = skipped.select("page_path").unionByName(rec.filter(F.col("_p.record_id").isNull()).select("page_path"))
    rec = rec.filter(F.col("_p.record_id").isNotNull())
    rec = rec.select("page_path", "to_lang", "arrival", F.col("_p.record_id").alias("record_id"),
                     F.col("_p.ts_local").alias("ts_local"),
                     index_record("translated", "_p", "url").alias("record"))
    hist = rec if history is None else history.unionByName(rec, allowMissingColumns=True)
    key = F.concat_ws("|", "to_lang", "record_id")
    hist = hist.withColumn("_id", key)
    newest = latest_version(hist, "_id", "ts_local", "arrival").drop("_id")
    # the create-only stream's documents also carry @timestamp = UTC crawl time
    first = first_version(hist, "_id", "arrival").drop("_id") \
        .withColumn("@timestamp", F.col("record.timestamp.utc"))
    return newest, first, skipped


def index_posts(translated: DataFrame, root: str, arrival: str = "arrival", history: DataFrame | None = None,
                tz: str = "UTC") -> DataFrame:
    """Post index (K7 for posts): translated posts (post_path, to_lang,
    status, translated, ``arrival``) become documents keyed by the post id
    (the file name) with country and crawl-time fields; posts go only to the
    append-only, create-only target, so the first version per id stays."""
    ok = translated.filter((F.col("status") == K.STATUS_OK) & F.col("translated").isNotNull())
    # ids come from the translated text file's name (``<id>.txt``), as in the original
    p = tweet_parts(with_suffix("post_path", ".txt"), root, tz)
    rec = ok.select("to_lang", F.col(arrival).alias("arrival"), p["record_id"].alias("record_id"), F.struct(
        F.col("translated").alias("text"), p["country"].alias("country"),
        F.struct(p["year"].alias("year"), p["month"].alias("month"), p["day"].alias("day"), p["hh"].alias("hh"),
                 p["mm"].alias("mm"), p["ts_local"].alias("local"), p["ts_utc"].alias("utc")).alias("timestamp"),
        p["filename"].alias("filename")).alias("record")).filter(F.col("record_id").isNotNull())
    hist = rec if history is None else history.unionByName(rec, allowMissingColumns=True)
    hist = hist.withColumn("_id", F.concat_ws("|", "to_lang", "record_id"))
    return first_version(hist, "_id", "arrival").drop("_id").withColumn("@timestamp", F.col("record.timestamp.utc"))


def classify_flow(ja_ok: DataFrame, en_ok: DataFrame, extracted: DataFrame, classified: DataFrame,
                  key: str, score) -> DataFrame:
    """J2 then a scorer (``score``: DataFrame -> DataFrame with ``status``,
    e.g. ``operators.scoring.enrich``).  Newest first by ``key``."""
    ready = L.ready_set(ja_ok, en_ok, extracted, classified, key)
    return score(ready)


def classified_records(items: DataFrame, root: str, keywords=K.COVID_KEYWORDS, topic=None) -> DataFrame:
    """U4 over ready items (page_path, region, site, title, text, ja_text,
    en_text): metadata -> text -> keyword -> topic, each checked.  Adds
    ``status`` (0: a record, 1: failed) and ``record``, the JSON object the
    classifier writes.  ``topic``: DataFrame -> DataFrame with a ``topic``
    column (null fails); without one the step passes."""
    parts = page_parts("page_path", root)
    steps = [("metadata", lambda x: x.withColumn("_p", parts), F.col("_p").isNotNull()),
             ("text", lambda x: x, (F.length("text") > 0) & (F.length("ja_text") > 0) & (F.length("en_text") > 0)),
             ("keywords", lambda x: x.withColumn("keyword", keyword_flag("text", keywords)), F.col("keyword").isNotNull())]
    if topic is not None:
        steps.append(("topic", topic, F.col("topic").isNotNull()))
    out = enrich(items, steps)
    first_line = lambda c: F.substring_index(c, "\n", 1)
    file = F.replace(F.col("page_path"), F.lit(root.rstrip("/") + "/"), F.lit(""))
    fields = [F.struct(file.alias("file"), "title").alias("orig"), F.struct(first_line("ja_text").alias("title"), F.col("ja_text").alias("text")).alias("ja_translated"),
              F.struct(first_line("en_text").alias("title"), F.col("en_text").alias("text")).alias("en_translated"),
              F.struct(F.col("_p.region").alias("region"), F.col("_p.site").alias("domain"), F.col("_p.ts_utc").alias("timestamp")).alias("meta"), "keyword"]
    return out.withColumn("record", F.when(F.col("status") == K.STATUS_OK, F.to_json(F.struct(*fields, *(["topic"] if topic is not None else [])))))


def classify_stream(spark, extracted_path: str, translated_path: str, root: str, out_path: str, ledger_path: str, checkpoint: str | None = None,
                    topic=None, keywords=K.COVID_KEYWORDS, once: bool = True, interval: str = "10 seconds"):
    """W1 for the classifier: pages whose Japanese and English texts are
    there (status 0), minus the ledger, matched on the feature key, which no
    stage folder or suffix changes; each poll writes JSON lines for the
    records and a ledger line (0 or 1) for every item."""
    stage = "classify"

    def poll() -> int:
        tr = read_if_exists(spark, translated_path)
        if tr is None:
            return 0
        key = lambda df: df.withColumn("_key", feature_key("page_path", root)).filter(F.col("_key").isNotNull())
        ok = key(tr.filter(F.col("status") == K.STATUS_OK).select("page_path", "to_lang", "translated"))
        ext = key(spark.read.parquet(extracted_path).select("page_path", "region", "site", "title", "text"))
        number = next_batch(spark, ledger_path, stage)
        led = read_if_exists(spark, ledger_path)
        done = spark.createDataFrame([], "_key string") if led is None else \
            key(led.filter((F.col("stage") == stage) & (F.col("batch_id") < number))).select("_key")
        ready = L.ready_set(ext.select("_key"), *[ok.filter(F.col("to_lang") == x).select("_key") for x in ("ja", "en")], done, "_key")
        items = ext.join(ready, "_key", "left_semi")
        for lang in ("ja", "en"):
            items = items.join(ok.filter(F.col("to_lang") == lang).select("_key", F.col("translated").alias(f"{lang}_text")), "_key")
        out = classified_records(items.drop("_key"), root, keywords, topic).select("page_path", "region", "status", "record").persist()
        try:
            (out.filter(F.col("record").isNotNull()).select(F.col("record").alias("value")).write.mode("overwrite")
             .text(f"{out_path}/batch_id={number}"))
            append_ledger(out, ledger_path, stage, batch_id=number)
            return out.count()
        finally:
            out.unpersist()

    return run_polls(spark, poll, checkpoint, once, interval)


def sentiment_stream(spark, classified_path: str, root: str, out_path: str, ledger_path: str, scorer, checkpoint: str | None = None,
                     once: bool = True, interval: str = "1000 seconds"):
    """W1 for the sentiment scorer: classified JSON lines whose page the
    ledger does not hold; ``scorer`` (DataFrame with ``title`` -> DataFrame
    with ``sentiment``) scores the titles, -1 without a title."""
    stage = "sentiment"

    def poll() -> int:
        number = next_batch(spark, ledger_path, stage)
        led = read_if_exists(spark, ledger_path)
        done = spark.createDataFrame([], "page_path string") if led is None else \
            led.filter((F.col("stage") == stage) & (F.col("batch_id") < number)).select("page_path")
        view = classified_view(read_jsonl(spark, classified_path), root).filter(~F.col("_corrupt"))
        todo = L.unscored_records(view, done).select(F.col("link").alias("page_path"), "title")
        out = scorer(todo)
        out = out.select("page_path", F.when(F.length("title") > 0, F.col("sentiment")).otherwise(-1.0).alias("sentiment")) \
            .withColumn("sentiment", F.coalesce("sentiment", F.lit(-1.0))).withColumn("status", F.lit(K.STATUS_OK)).persist()
        try:
            (out.select(F.to_json(F.struct(F.col("page_path").alias("file"), "sentiment")).alias("value")).write.mode("overwrite")
             .text(f"{out_path}/batch_id={number}"))
            append_ledger(out, ledger_path, stage, batch_id=number)
            return out.count()
        finally:
            out.unpersist()

    return run_polls(spark, poll, checkpoint, once, interval)


def read_posts(lines: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """S8 + X3 for post pages named in manifest lines (``page_path``,
    ``ordinal``): read on the executors, the text of the page's first <p>
    and the ``lang`` field of its ``.json`` sidecar (null when missing,
    which the post flow records as status 9).  Returns (post_path, ordinal,
    text, lang)."""
    pages = read_named_files(lines.select("page_path", ordinal), "page_path", "html", "_m1")
    side = pages.withColumn("_json_path", with_suffix("page_path", ".json"))
    side = read_named_files(side, "_json_path", "_json", "_m2")
    return side.select(F.col("page_path").alias("post_path"), ordinal,
                       F.coalesce(post_text("html"), F.lit("")).alias("text"),
                       json_field("_json", "lang").alias("lang"))


def posts_flow(posts: DataFrame, ledger: DataFrame | None, to_lang: str, n: int = K.TWEET_HEAD_TAIL,
               translate_fn: TranslateFn = passthrough) -> DataFrame:
    """Short posts (post_path, ordinal, text, lang): not yet translated,
    first and last ``n`` in arrival order, translated one part each."""
    todo = posts if ledger is None else L.unprocessed(posts, ledger, "post_path")
    todo = L.head_tail(todo, ["ordinal", "post_path"], n)
    return translate_posts(todo, "post_path", "text", "lang", to_lang, translate_fn)


def extract_stream(spark, manifest_dir: str, root: str, out_path: str, ledger_path: str, checkpoint: str | None = None,
                   days: int = K.EXTRACT_DAY_WINDOW, quota: int = K.EXTRACT_SITE_QUOTA, region: str | None = None,
                   name_glob: str = "*.txt", once: bool = True, today=None, interval: str = "10 seconds"):
    """W1 for the extract loop.  A poll reads the manifests of the day window
    as they are now, takes the first ``quota`` lines of each region and site
    (before the ledger, Q7), drops what the ledger holds, reads the listed
    pages on the executors, extracts, and writes records (partitioned by
    region), quarantine and ledger lines under one number.  Returns the
    number of items taken, or the running query when it keeps polling."""
    def poll() -> int:
        day = today or dt.date.today()
        lines = recent_pages(spark, manifest_dir, days, root, region, day, name_glob)
        number = next_batch(spark, ledger_path, "extract")
        led = read_if_exists(spark, ledger_path)
        if led is not None:
            # A line of the window was processed on or after its manifest's
            # date, so only ledger days inside the window can hold it: the
            # stage and day partitions outside are pruned, not read.
            led = led.filter((F.col("stage") == "extract") & (F.col("day") >= F.lit(day - dt.timedelta(days=days)))
                             & (F.col("batch_id") < number)).select("page_path")
        rec, led_lines = extract_flow(lines, None, led, quota=quota)
        rec = rec.persist()
        led_lines = led_lines.persist()
        try:
            write_extracted(rec, out_path, batch_id=number)
            quarantine(led_lines.filter(F.col("status") != K.STATUS_OK), f"{ledger_path}_errors", "extract",
                       "page_path", "page file missing", batch_id=number)
            append_ledger(led_lines, ledger_path, "extract", batch_id=number)
            return led_lines.count()
        finally:
            led_lines.unpersist()
            rec.unpersist()

    return run_polls(spark, poll, checkpoint, once, interval)


def translate_stream(spark, extracted_path: str, out_path: str, ledger_path: str, checkpoint: str | None, to_lang: str,
                     quota: int = K.TRANSLATE_SITE_QUOTA, translate_fn: TranslateFn = passthrough,
                     memory_path: str | None = None, once: bool = True, interval: str = "1 second",
                     retry_status=None, lang_sidecars: bool = True, manifest_path: str | None = None):
    """W1 for the translate loop.  A poll runs ``translate_flow`` over the
    whole extracted table against the ledger and writes results, the hourly
    manifest of new targets (K5) and ledger lines under one number.
    ``memory_path``: translation memory, read and added to.  Items whose
    target the table already holds get status 5."""
    stage = f"translate_{to_lang}"

    def poll() -> int:
        records = spark.read.parquet(extracted_path)
        there = read_if_exists(spark, out_path)
        if there is not None:
            there = there.filter(F.col("to_lang") == to_lang)
        number = next_batch(spark, ledger_path, stage, there)
        led = read_if_exists(spark, ledger_path)
        if led is not None:
            led = led.filter((F.col("stage") == stage) & (F.col("batch_id") < number)).select("page_path", "status")
        if there is not None:
            there = there.filter((F.col("batch_id") < number) & (F.col("status") == K.STATUS_OK)).select("page_path")
        memory = read_if_exists(spark, memory_path) if memory_path else None
        out, _ = translate_flow(records, led, to_lang, quota=quota, translate_fn=translate_fn, memory=memory,
                                done=there, retry_status=retry_status, memory_out=memory_path,
                                lang_sidecars=lang_sidecars, batch_id=number)
        out = out.persist()
        try:
            # a target that was there stays as it is: only its ledger line is new
            write_translated(out.filter(F.col("status") != K.STATUS_EXISTS), out_path, batch_id=number)
            if manifest_path:
                write_hourly_manifest(out.filter(F.col("status") == K.STATUS_OK).withColumn("processed_at", F.current_timestamp()),
                                      manifest_path, batch_id=number)
            append_ledger(out, ledger_path, stage, extra=["region", "to_lang"], batch_id=number)
            return out.count()
        finally:
            out.unpersist()

    return run_polls(spark, poll, checkpoint, once, interval)


def posts_from_lines(lines: DataFrame, ledger: DataFrame | None, to_lang: str, n: int = K.TWEET_HEAD_TAIL,
                     translate_fn: TranslateFn = passthrough) -> DataFrame:
    """The post loop from manifest lines (page_path, ordinal): the ledger
    check and the first/last ``n`` choice need only the lines, so they run
    first and only the chosen posts' files are read (once)."""
    todo = lines.select(F.col("page_path").alias("post_path"), "ordinal")
    if ledger is not None:
        todo = L.unprocessed(todo, ledger, "post_path")
    todo = L.head_tail(todo, ["ordinal", "post_path"], n)
    posts = read_posts(todo.withColumnRenamed("post_path", "page_path"))
    return translate_posts(posts, "post_path", "text", "lang", to_lang, translate_fn)


def posts_stream(spark, manifest_dir: str, prefix: str, out_path: str, ledger_path: str, checkpoint: str | None,
                 to_lang: str, n: int = K.TWEET_HEAD_TAIL, translate_fn: TranslateFn = passthrough,
                 name_glob: str = "*.txt", once: bool = True, interval: str = "10 seconds"):
    """W1 for the short-post loop: a poll takes all listed posts minus the
    ledger, first and last ``n`` of the rest, and writes translations and
    ledger lines under one number."""
    stage = f"posts_{to_lang}"

    def poll() -> int:
        lines = recent_posts(spark, manifest_dir, prefix, name_glob=name_glob).withColumn(
            "ordinal", F.struct("file_date", "file_name", "line_no"))
        number = next_batch(spark, ledger_path, stage)
        led = read_if_exists(spark, ledger_path)
        if led is not None:
            led = led.filter((F.col("stage") == stage) & (F.col("batch_id") < number)).select(
                F.col("page_path").alias("post_path"))
        out = posts_from_lines(lines, led, to_lang, n=n, translate_fn=translate_fn) \
            .withColumn("arrival", arrival_order("post_path", number)).persist()
        try:
            write_translated(out, out_path, batch_id=number)
            append_ledger(out, ledger_path, stage, key="post_path", extra=["to_lang"], batch_id=number)
            return out.count()
        finally:
            out.unpersist()

    return run_polls(spark, poll, checkpoint, once, interval)
