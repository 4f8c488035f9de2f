import pytest


@pytest.fixture
def docs_table(spark, tmp_path):
    """Writes rows of (doc_id, text, lang, source) as a documents table with columns whose names clash with ours."""
    schema = ("doc_id long, text string, lang string, source string, n_chars long, score double, size long, "
              "component_id long, kept boolean, label int, copies int")

    def make(rows, folder="t"):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or ""),
                 9.0, 9, 9, True, 9, 9) for r in rows]
        path = str(tmp_path / folder / "documents.parquet")
        spark.createDataFrame(full, schema).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    return make
