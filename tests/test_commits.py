"""Run commits, the bucketed seen-set and index, repeated runs and the retry stream."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from feedlake.operators import dedupe, registry, state
from feedlake.operators import seen as S
from feedlake.plans import inputs as I
from feedlake.plans import jobs
from feedlake.sources import commits

from test_jobs_io import _checks, _day


def _ids(df):
    return sorted(r.id for r in df.collect())


# ------------------------------------------------------------------- commits

def test_a_commit_moves_all_tables_at_once(spark, tmp_path):
    base = str(tmp_path / "base")
    first = commits.begin(spark, base, "r1")
    first.write("a", spark.range(3), "2024-01-01")
    first.write_parts("nested/b", spark.range(10).selectExpr("id", "id % 3 as bucket"), "bucket", [])
    assert commits.current(spark, base).tables == {} and _ids(first.read("a")) == [0, 1, 2]
    first.commit()
    old = commits.current(spark, base)
    second = commits.begin(spark, base, "r2")
    second.write("a", spark.range(5, 7), "2024-01-02")
    second.write_parts("nested/b", spark.createDataFrame([(1, 1)], "id long, bucket int"), "bucket", ["1", "2"])
    assert _ids(commits.current(spark, base).read("a")) == [0, 1, 2]
    second.commit()
    now = commits.current(spark, base)
    assert _ids(now.read("a")) == [0, 1, 2, 5, 6] and _ids(now.read("a", ["2024-01-02"])) == [5, 6]
    assert sorted(now.parts("nested/b")) == ["0", "1"] and _ids(now.read("nested/b")) == [0, 1, 3, 6, 9]
    assert now.parts("nested/b")["0"] == old.parts("nested/b")["0"]  # an untouched bucket keeps its files
    assert _ids(old.read("a")) == [0, 1, 2]  # a reader of the earlier state still sees it
    assert now.read("c") is None and now.read("a", ["2024-01-03"]) is None


def test_two_runs_on_one_state_conflict(spark, tmp_path):
    base = str(tmp_path / "base")
    one, two = commits.begin(spark, base, "r1"), commits.begin(spark, base, "r2")
    one.write("a", spark.range(1))
    two.write("a", spark.range(2))
    one.commit()
    with pytest.raises(commits.CommitConflict):
        two.commit()
    assert _ids(commits.current(spark, base).read("a")) == [0]


def test_a_repeated_run_replaces_itself_until_another_builds_on_it(spark, tmp_path):
    base = str(tmp_path / "base")
    for run, n in (("r1", 1), ("r2", 2), ("r2", 3)):
        tx = commits.begin(spark, base, run)
        assert ("r2" not in tx.parts("a")) and (run == "r1" or "r1" in tx.parts("a"))
        tx.write("a", spark.range(n), run)
        tx.commit()
    assert commits.current(spark, base).read("a", ["r2"]).count() == 3
    with pytest.raises(commits.AlreadyCommitted):
        commits.begin(spark, base, "r1")


def test_vacuum_keeps_what_records_name(spark, tmp_path):
    base = str(tmp_path / "base")
    for n in range(4):
        tx = commits.begin(spark, base, f"r{n}")
        tx.write("a/x", spark.range(n + 1))
        tx.write_parts("a/b", spark.range(4).selectExpr("id", "id as bucket").where(f"id = {n}"), "bucket", [str(n)])
        tx.commit()
    lost = commits.begin(spark, base, "lost")
    lost.write("a/x", spark.range(9))
    assert commits.vacuum(spark, base, keep=1, older_than_s=3600) == 0  # all folders are young
    assert commits.vacuum(spark, base, keep=1, older_than_s=-1) == 3    # x of r0 and r1, and the lost one; r2 can be gone back to
    now = commits.current(spark, base)
    assert now.read("a/x").count() == 4 and _ids(now.read("a/b")) == [0, 1, 2, 3]
    assert [s.number for s in commits.log(spark, base)] == [2, 3]


# ------------------------------------------------------------------ seen-set

SEEN = "canonical_url string, article_id string, content_hash string, first_seen timestamp, last_seen timestamp"


def _kept(spark, rows):
    return spark.createDataFrame([(u, f"id{u}", h, "2024-01-31T06:00:00+00:00", i) for i, (u, h) in enumerate(rows)],
                                 "canonical_url string, article_id string, content_hash string, fetched_at string, seq long")


def _table(df):
    return sorted((tuple(r) for r in df.select("canonical_url", "article_id", "content_hash", "first_seen", "last_seen").collect()), key=repr)


def test_bucketed_seen_set_equals_the_whole_table(spark, tmp_path):
    rnd = random.Random(4)
    base, whole = str(tmp_path / "base"), spark.createDataFrame([], SEEN)
    for n in range(4):
        rows = [(f"https://x/{rnd.randint(0, 60)}", rnd.choice([None, *(f"h{k}" for k in range(25))])) for _ in range(30)]
        rows = list(dict(rows).items())
        candidates = _kept(spark, rows + [("https://x/none", None), (None, "h1"), (None, None)])
        tx = commits.begin(spark, base, f"r{n}")
        seen = S.SeenSet(tx, buckets=8)
        want = dedupe.filter_unseen(candidates, whole)
        assert _ids(dedupe.filter_unseen(candidates, seen).withColumn("id", F.col("seq"))) == _ids(want.withColumn("id", F.col("seq")))
        new = dedupe.filter_new(candidates, seen, fallback_col="article_id").select("seq")
        assert sorted(new.collect()) == sorted(dedupe.filter_new(candidates, whole, fallback_col="article_id").select("seq").collect())
        kept = _kept(spark, rows)
        seen.remember(kept)
        whole = spark.createDataFrame(state.remember(whole, kept).collect(), SEEN)
        tx.commit()
        now = commits.current(spark, base)
        assert _table(S.SeenSet(now).rows()) == _table(whole)
        counts = {r.content_hash: r.n for r in now.read("state/seen_hashes").collect()}
        assert counts == {r.content_hash: r["count"] for r in whole.where("content_hash is not null").groupBy("content_hash").count().collect()}


def test_a_small_batch_touches_few_buckets(spark, tmp_path):
    base = str(tmp_path / "base")
    tx = commits.begin(spark, base, "r0")
    S.SeenSet(tx, buckets=32).replace(spark.range(2000).selectExpr(
        "concat('https://x/', id) canonical_url", "'a' article_id", "concat('h', id) content_hash", "timestamp'2024-01-01' first_seen", "timestamp'2024-01-01' last_seen"))
    tx.commit()
    before = commits.current(spark, base)
    tx = commits.begin(spark, base, "r1")
    seen = S.SeenSet(tx)
    assert seen.buckets == 32  # fixed when the set was made
    known = seen.known_urls(spark.createDataFrame([("https://x/7",), ("https://y/7",), (None,)], "u string"))
    assert [r[0] for r in known.collect()] == ["https://x/7"]
    read = [f for f in known.inputFiles() if "/state/seen/" in f]
    assert read and all("bucket=" in f for f in read) and len({f.rsplit("/", 2)[1] for f in read}) == 1
    seen.remember(_kept(spark, [("https://x/7", "new"), ("https://z/1", "h3")]))
    after = tx.commit()
    for table, most in (("state/seen", 2), ("state/seen_filter", 2), ("state/seen_hashes", 3), ("state/seen_hashes_filter", 3)):
        changed = [p for p, f in after.parts(table).items() if before.parts(table).get(p) != f]
        assert 1 <= len(changed) <= most, table
    assert S.SeenSet(after).rows().count() == 2001
    assert S.SeenSet(after).known_hashes(spark.createDataFrame([("h7",), ("new",), ("h3",)], "h string")).count() == 2


def test_filters_let_few_unknown_keys_pass(spark):
    rows = spark.range(3000).selectExpr("concat('https://x/', id) u")
    bits = S.bloom_filters(rows, "u", 1, 1)
    probe = spark.range(20000).selectExpr("concat('https://y/', id) u", "0 as fine").unionByName(rows.selectExpr("u", "0 as fine"))
    passed = probe.join(bits, "fine").where(S.has_bits(F.col("bits"), S.bit_positions(F.col("u")))).select("u")
    assert passed.where("u like 'https://x/%'").count() == 3000
    assert passed.where("u like 'https://y/%'").count() < 20000 * 0.03


def test_resize_keeps_the_rows(spark, tmp_path):
    base = str(tmp_path / "base")
    tx = commits.begin(spark, base, "r0")
    S.SeenSet(tx, buckets=2).remember(_kept(spark, [(f"https://x/{i}", f"h{i % 7}") for i in range(50)]))
    tx.commit()
    tx = commits.begin(spark, base, "r1")
    S.SeenSet(tx).resize(8, bitmaps=2)
    now = S.SeenSet(tx.commit())
    assert (now.buckets, now.bitmaps, now.rows().count()) == (8, 2, 50)
    assert now.known_urls(spark.createDataFrame([("https://x/3",), ("https://x/99",)], "u string")).count() == 1


def test_seen_set_of_a_snapshot_is_read_only(spark, tmp_path):
    with pytest.raises(TypeError):
        S.SeenSet(commits.current(spark, str(tmp_path / "none"))).remember(_kept(spark, [("https://x/1", "h")]))


# --------------------------------------------------------------------- index

def test_index_in_buckets_rewrites_what_the_batch_touches(spark, tmp_path):
    base, schema = str(tmp_path / "base"), "article_id string, title string, seq long"
    batches = [[(f"a{i}", f"t{i}", i) for i in range(40)], [("a3", "new", 0), ("b", "one", 1), ("b", "two", 2)],
               [("c", "x", 5), ("c", "y", 5), ("a3", "newer", 9)]]
    states = []
    for n, rows in enumerate(batches):
        tx = commits.begin(spark, base, f"r{n}")
        state.merge_index_buckets(tx, "index", spark.createDataFrame(rows, schema), f"2024-01-0{n + 1}", buckets=16)
        states.append(tx.commit())
    rows = {r.article_id: r for r in states[-1].read("index").collect()}
    assert len(rows) == 42 and states[-1].read("index").count() == 42  # the tie of c gives one row
    assert (rows["a3"].title, rows["a3"].first_run_date, rows["a3"].first_seq) == ("newer", "2024-01-01", 3)
    assert (rows["b"].title, rows["b"].first_seq) == ("two", 1) and rows["c"].title in ("x", "y")
    changed = [p for p, f in states[1].parts("index").items() if states[0].parts("index").get(p) != f]
    assert len(changed) <= 2


def test_merge_index_resolves_ties(spark):
    batch = spark.createDataFrame([("a", "one", 1), ("a", "two", 1), ("a", "two", 1)], "article_id string, title string, seq long")
    empty = batch.limit(0).withColumns({"first_run_date": F.lit(""), "first_seq": F.col("seq")})
    assert state.merge_index(empty, batch, "2024-01-01").count() == 1


def test_checkpoints_by_merging(spark):
    rows = [(f"2024-01-{d:02d}", d % 3 == 0, "completed" if d % 4 else "failed") for d in range(1, 31)]
    man = spark.createDataFrame(rows, "run_date string, dry_run boolean, status string")
    last = None
    for d in range(0, 30, 10):
        last = state.next_checkpoints(last, spark.createDataFrame(rows[d:d + 10], man.schema))
    assert last.collect() == state.checkpoints(man).collect()


# ------------------------------------------------------------- repeated runs

def _start(spark, base):
    """State before the first run: one publication, one article seen."""
    reg = registry.empty_registry(spark).unionByName(registry.with_registry_defaults(spark.createDataFrame(
        [("https://feed.example.com/", "Feed")], "publication_url string, publication_name string")))
    tx = commits.begin(spark, base, "start")
    tx.write("state/registry", reg)
    S.SeenSet(tx, buckets=4).remember(_kept(spark, [("https://old.example.com/p/seen", "h")]))
    tx.commit()


def _visible(spark, base):
    """Everything that a reader sees, without run clocks."""
    now = commits.current(spark, base)
    out = {}
    for table in ("latest/batch", "latest/successful", "processed/articles", "processed/index", "archive/digest", "runs/manifests", "runs/status",
                  "runs/errors", "state/registry", "state/checkpoints", "state/seen", "state/seen_hashes", "latest/registry_snapshot"):
        df = now.read(table)
        out[table] = None if df is None else sorted(df.select(F.to_json(F.struct(*sorted(df.columns)))).toPandas().iloc[:, 0])
    return out


class Killed(BaseException):
    """The process is gone: no handler of the job runs."""


def test_a_run_killed_after_any_write_is_simply_repeated(spark, tmp_path, monkeypatch):
    day = _day(spark, [("a", "one", "text one"), ("b", "two", "text two"), ("c", "dup", "text one")])
    cfg = jobs.RunConfig(run_ts="2026-03-11 06:00:00", source_profile="https://reads.example.com/@me")

    def run(base):
        return jobs.run_with_health(spark, cfg, _checks(spark, True), base=base, **day)

    whole = str(tmp_path / "whole")
    _start(spark, whole)
    writes, folder = [], commits.Transaction._folder
    monkeypatch.setattr(commits.Transaction, "_folder", lambda self, table: writes.append(table) or folder(self, table))
    assert run(whole)["run_status"].first().run_status == "healthy"
    want = _visible(spark, whole)
    total = len(writes)
    assert total > 15 and len(want["latest/batch"]) == 3 and len(want["runs/manifests"]) == 1

    base = str(tmp_path / "base")
    _start(spark, base)
    before = _visible(spark, base)
    last = [i for i, t in enumerate(writes[:total]) if t.startswith("state/seen")][-1]
    for stop in (last + 1, total):  # after the seen-set, after the status row
        left = [stop]

        def dying(self, table, left=left):
            left[0] -= 1
            if left[0] < 0:
                raise Killed
            return folder(self, table)

        monkeypatch.setattr(commits.Transaction, "_folder", dying)
        if stop == total:  # all is written, only the commit is missing
            monkeypatch.setattr(commits.Transaction, "commit", lambda self: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            run(base)
        monkeypatch.undo()
        assert _visible(spark, base) == before
    assert run(base)["run_status"].first().run_status == "healthy"
    assert _visible(spark, base) == want


def test_a_failed_day_is_repeated(spark, tmp_path):
    base = str(tmp_path / "base")
    _start(spark, base)
    day = _day(spark, [("a", "one", "text one")])
    cfg = jobs.RunConfig(run_ts="2026-03-11 06:00:00", source_profile="https://reads.example.com/@me")
    broken = day | {"fetched": day["fetched"].drop("html")}
    assert jobs.run_with_health(spark, cfg, _checks(spark, True), base=base, **broken)["run_status"].first().run_status == "failed"
    assert commits.current(spark, base).read("latest/batch") is None
    assert jobs.run_with_health(spark, cfg, _checks(spark, True), base=base, **day)["run_status"].first().run_status == "healthy"
    now = commits.current(spark, base)
    assert [r.run_status for r in now.read("runs/status").collect()] == ["healthy"] and now.read("latest/batch").count() == 2


# -------------------------------------------------------------------- stream

def test_failed_pages_wait_until_they_succeed(spark, tmp_path):
    from feedlake.streaming.incremental import QUERY_SETTINGS, incremental_articles
    settings = {k: spark.conf.get(k, None) for k in QUERY_SETTINGS}
    html = "<html><article>text {}</article></html>"
    arrivals = [
        [(1, "https://a/p/1", html.format(1), None), (2, "https://a/p/2", None, "403"), (3, "https://a/p/3", None, "timed out"), (4, "https://a/p/4", None, None)],
        [(2, "https://a/p/2/", html.format(2), None), (3, "https://a/p/3", None, "timed out again"), (5, "https://a/p/5", html.format(1), None)],
        [(3, "https://a/p/3", None, "gone"), (4, "https://a/p/4?x=1", html.format(4), None), (4, "https://a/p/4", None, "late error")],
        [(3, "https://a/p/3", html.format(3), None)]]
    want = [([1], {"https://a/p/2": ("retry", 1, "403"), "https://a/p/3": ("retry", 1, "timed out"), "https://a/p/4": ("retry", 1, "page was not fetched")}),
            ([1, 2], {"https://a/p/3": ("retry", 2, "timed out again"), "https://a/p/4": ("retry", 1, "page was not fetched")}),
            ([1, 2, 4], {"https://a/p/3": ("given_up", 3, "gone")}),
            ([1, 2, 3, 4], {})]
    src, ckpt, base = str(tmp_path / "in"), str(tmp_path / "ckpt"), str(tmp_path / "base")
    for rows, (articles, queue) in zip(arrivals, want):
        spark.createDataFrame(rows, "page_id long, url string, html string, error string").write.mode("append").parquet(src)
        incremental_articles(spark, src, ckpt, base, I.RUN_ISO, file_glob="*.parquet", max_attempts=3).awaitTermination()
        now = commits.current(spark, base)
        assert sorted(r.seq for r in now.read("articles").collect()) == articles
        assert {r.canonical_url: (r.kind, r.attempts, r.error) for r in now.read("retry").collect()} == queue
    assert {k: spark.conf.get(k, None) for k in QUERY_SETTINGS} == settings
