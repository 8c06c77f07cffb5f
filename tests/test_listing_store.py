from stratavault.catalog import files_queries


def test_a_language_is_written_by_the_partitions_of_the_table(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "objects")
    monkeypatch.setattr(files_queries, "scratch_path", lambda *_: root)
    spark.range(400).selectExpr("id AS doc_id", "concat('text ', id) AS text", "concat('l', id % 20) AS lang").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    found = files_queries.stored_listing(spark, str(tmp_path)).collect()
    assert len(found) == 20 and {(r.has_files, r.n_rows) for r in found} == {(True, 20)}
    assert len(list((tmp_path / "objects" / "store=b0" / "language=l0").glob("*.parquet")) + list((tmp_path / "objects" / "store=b0").glob("language=*/*.parquet"))) > 20
