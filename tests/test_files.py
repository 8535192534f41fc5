"""Names by path, and the committed sink."""

import pytest
from pyspark.sql import functions as F

from docprep.sources import files, sink

DOCS = "file_final string, text string"


def names(folder):
    return sorted(p.relative_to(folder).as_posix() for p in folder.rglob("*") if p.is_file() and not p.name.endswith(".crc"))


def test_equal_names_of_two_folders_stay_apart(spark, tmp_path):
    for where in ("a", "b/c d", "b+ñ"):
        (tmp_path / where).mkdir(parents=True)
        (tmp_path / where / "x.md").write_text(where)
    want = {"a/x.md": "a", "b/c d/x.md": "b/c d", "b+ñ/x.md": "b+ñ"}
    for folder in (str(tmp_path), f"file://{tmp_path}/"):
        assert {r.file_name: r.text for r in files.read_markdown(spark, folder, full=True).collect()} == want
        assert {r.file_name: bytes(r.content).decode() for r in files.read_bytes(spark, folder, "*.md", full=True).collect()} == want
    assert [r.file_name for r in files.read_markdown(spark, str(tmp_path / "a")).collect()] == ["x.md"]


def test_documents_are_committed_as_a_whole(spark, tmp_path):
    out = tmp_path / "out"
    docs = spark.createDataFrame([(f"{k}.md", f"texto ñ {k}") for k in range(20)] + [("vacío.md", None)], DOCS).repartition(5)
    for folder in (str(out), f"file://{out}"):
        files.export_markdown(docs, folder)
        assert names(out) == sorted([*(f"{k}.md" for k in range(20)), "vacío.md", "_SUCCESS"])
    assert (out / "7.md").read_text() == "texto ñ 7" and (out / "vacío.md").read_text() == ""
    files.export_markdown(docs.where("file_final = '7.md'").withColumn("text", F.lit("otro")), str(out))
    assert (out / "7.md").read_text() == "otro" and (out / "8.md").read_text() == "texto ñ 8"


def test_a_failed_run_leaves_nothing(spark, tmp_path):
    out = tmp_path / "out"
    files.export_markdown(spark.createDataFrame([("old.md", "viejo")], DOCS), str(out))
    bad = spark.createDataFrame([(f"{k}.md", str(k)) for k in range(20)] + [("old.md", "nuevo"), ("../up.md", "x")], DOCS).repartition(4)
    with pytest.raises(Exception, match="can't be written"):
        files.export_markdown(bad, str(out))
    assert names(out) == ["_SUCCESS", "old.md"] and (out / "old.md").read_text() == "viejo" and names(tmp_path) == ["out/_SUCCESS", "out/old.md"]


def test_two_documents_of_one_name_are_refused(spark, tmp_path):
    with pytest.raises(Exception, match="two documents have the name a.md"):
        files.export_markdown(spark.createDataFrame([("a.md", "1"), ("b.md", "2"), ("a.md", "3")], DOCS).repartition(3), str(tmp_path / "o"))
    assert names(tmp_path) == []


class Attempt:
    """Stands for a task's context."""

    def __init__(self, number):
        self.number = number

    def partitionId(self):  # noqa: N802
        return 0

    def taskAttemptId(self):  # noqa: N802
        return self.number


def test_attempts_that_do_not_count_leave_nothing(tmp_path, monkeypatch):
    """A speculative attempt that ends, and one that breaks off in a file, beside the one that is committed."""
    writer = sink.DocumentWriter({"path": str(tmp_path / "o")})

    def attempt(number, rows):
        monkeypatch.setattr(sink.TaskContext, "get", lambda: Attempt(number))
        return writer.write(iter(rows))

    first = attempt(1, [("a.md", "uno"), ("b.md", "dos")])
    attempt(2, [("a.md", "UNO"), ("c.md", "otra")])

    def broken():
        yield "a.md", "mitad"
        raise OSError("gone")

    with pytest.raises(OSError, match="gone"):
        attempt(3, broken())
    writer.commit([first, None])
    assert names(tmp_path / "o") == ["_SUCCESS", "a.md", "b.md"] and (tmp_path / "o" / "a.md").read_text() == "uno"


def test_no_documents(spark, tmp_path):
    files.export_markdown(spark.createDataFrame([], DOCS), str(tmp_path / "o"))
    assert names(tmp_path) == ["o/_SUCCESS"]
