"""Catalogue queries over small tables: every row comes out, with the whole result."""

from postlens.plans import catalogue


def run(spark, folder, name, **tables):
    for t, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/{t}.parquet")
    return [tuple(r) for r in catalogue.QUERIES[name](spark, str(folder)).collect()]


def test_merged_lists_keep_every_row_and_worker(spark, tmp_path):
    jobs = [(1, "a", "w1"), (2, "a", None), (3, "b", "w2"), (4, "", "w3"), (5, None, "w1"), (6, "c", None)]
    incoming = [(10, 2, "a", "w1"), (11, 1, "a", "w9"), (12, 3, "a", "w4"), (13, 1, "b", "w2"), (14, 1, "", "w8"), (15, 1, None, "w8")]
    got = run(
        spark, tmp_path, "merged_lists_jobs",
        linkedin_jobs=("row_id bigint, linkedin_job_id string, worker_id string", jobs),
        linkedin_incoming=("incoming_id bigint, batch_no int, linkedin_job_id string, worker_id string", incoming),
    )
    assert sorted(got) == [(1, "w1;w9;w4"), (2, "w9;w1;w4"), (3, "w2"), (4, "w3"), (5, "w1"), (6, "")]


def test_epoch_iso_gives_every_row(spark, tmp_path):
    posted = {
        "1700000000": "2023-11-14T22:13:20", "-1": "1969-12-31T23:59:59", "253402300799": "9999-12-31T23:59:59", "-62135596800": "0001-01-01T00:00:00",
        "253402300800": "253402300800", "1757965670884": "1757965670884", "1758286995078252": "1758286995078252", "99999999999999999999": "99999999999999999999",
        "soon": "soon", "": "", None: None,
    }
    got = run(spark, tmp_path, "epoch_iso_jobs", sap_jobs=("row_id bigint, posted_at string", list(enumerate(posted))))
    assert sorted(got) == list(enumerate(posted.values()))


def test_merge_shards_merges_every_row_by_posting(spark, tmp_path):
    rows = [
        (1, "7", "t", "c", "l", "u", "text", "d2", "d2", "w2"), (2, " 7", "s", "c", "l", "u", "longer text", "d1", "d3", "w1"),
        (3, None, "A", "c", "l", "u", "x", "d1", "d1", "w3"), (4, "", "a ", "C", "l", "u", None, "d2", "d2", "w1"),
        (5, "", "b", "c", "l", "u", "y", "d1", "d1", "w1"), (6, " ", "b", "c", "l", "v", None, "d1", "d1", "w1"),
    ]
    schema = "row_id bigint, linkedin_job_id string, title string, company string, location string, url string, description string, first_seen_snapshot string, last_seen_snapshot string, worker_id string"
    got = run(spark, tmp_path, "merge_shards_jobs", linkedin_jobs=(schema, rows))
    assert sorted(r[1:] for r in got) == [("A", 1, "d1", "d2", "w1; w3"), ("b", 0, "d1", "d1", "w1"), ("b", 1, "d1", "d1", "w1"), ("t", 11, "d1", "d3", "w1; w2")]
    assert "7" in {r[0] for r in got} and len({r[0] for r in got}) == 4
