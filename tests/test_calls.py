"""Calls under way side by side, back-off, kept answers, and assembly of documents from streams of answers."""

import email.message
import random
import time
import urllib.error

import pytest

from docprep.plans import stages
from docprep.sources import connectors
from docprep.streaming import assembly

QUESTIONS = "file_name string, chunk_idx long, prompt string, max_tokens long"


def questions(spark, n, parts=1):
    return spark.createDataFrame([(f"f{k % 7}", k, f"q\n\n{k}", 4000) for k in range(n)], QUESTIONS).repartition(parts)


def slow(system, user, max_tokens):
    time.sleep(0.1)
    return user.split("\n\n")[1] + ".", 1, 2, "m"


def uneven(system, user, max_tokens):
    k = int(user.split("\n\n")[1])
    time.sleep(0.02 * (k * 7 % 5))
    if k % 10 == 3:
        raise ValueError(f"bad {k}")
    return f"{k}.", 1, 2, "m"


def test_calls_run_side_by_side(spark):
    rows = questions(spark, 60)
    connectors.call_model(questions(spark, 1), "", slow).collect()
    took = []
    for n in (1, 8):
        began = time.time()
        got = connectors.call_model(rows, "", slow, in_flight=n).collect()
        took.append(time.time() - began)
        assert len(got) == 60 and all(r.content == f"{r.chunk_idx}." for r in got)
    assert took[0] > 6 and took[1] < took[0] / 3


def test_results_keep_their_order_and_errors_their_rows(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = questions(spark, 100)
        order = [r.chunk_idx for r in rows.collect()]
        got = connectors.call_model(rows, "", uneven, in_flight=9).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [r.chunk_idx for r in got] == order
    for r in got:
        assert (r.error, r.content) == ((f"ValueError: bad {r.chunk_idx}", None) if r.chunk_idx % 10 == 3 else (None, f"{r.chunk_idx}."))


def http(code, after=None):
    head = email.message.Message()
    if after is not None:
        head["Retry-After"] = after
    return urllib.error.HTTPError("http://x", code, "no", head, None)


class Flaky:
    """Fails as listed, then answers; notes when it was called."""

    def __init__(self, *errors):
        self.errors, self.times = list(errors), []

    def __call__(self, system, user, max_tokens):
        self.times.append(time.monotonic())
        if self.errors:
            raise self.errors.pop(0)
        return "done.", 1, 1, "m"


@pytest.mark.parametrize(
    ("errors", "attempts", "calls", "answered"),
    [([TimeoutError()], 3, 2, True), ([http(503), http(429)], 3, 3, True), ([http(401)], 3, 1, False), ([ValueError()], 3, 1, False), ([http(500)] * 3, 3, 3, False), ([ConnectionError()], 1, 1, False)],
)
def test_back_off_by_kind(errors, attempts, calls, answered):
    backend = Flaky(*errors)
    got = connectors.Caller(backend, "", True, attempts, 0.01).answer("q", 4000)
    assert len(backend.times) == calls and (got[0] == "done.") == answered and (got[-1] is None) == answered


def test_waits_grow_and_servers_are_heard():
    backend = Flaky(http(500), http(500), http(500))
    connectors.Caller(backend, "", True, 4, 0.05).answer("q", 4000)
    gaps = [b - a for a, b in zip(backend.times, backend.times[1:], strict=False)]
    assert gaps[0] >= 0.05 and gaps[1] >= 0.1 and gaps[2] >= 0.2
    backend = Flaky(http(429, "1"))
    caller = connectors.Caller(backend, "", True, 2, 0.01)
    caller.answer("q", 4000)
    assert backend.times[1] - backend.times[0] >= 1 and caller.not_before > 0


class Counted:
    def __init__(self, folder):
        self.folder = folder

    def __call__(self, system, user, max_tokens):
        import uuid

        (self.folder / uuid.uuid4().hex).touch()
        return user.split("\n\n", 1)[-1] + ".", 10, 5, "m"


def test_null_keys_are_answered_once(spark, tmp_path):
    (tmp_path / "calls").mkdir()
    rows = spark.createDataFrame([(None, 0, "p\n\na", 4000), (None, None, "p\n\nb", 4000), ("f", 0, None, 4000)], QUESTIONS)
    for _ in range(2):
        got = connectors.call_once(rows, str(tmp_path / "s"), "", Counted(tmp_path / "calls"), steps=5).collect()
        assert sorted((r.file_name or "-", r.chunk_idx if r.chunk_idx is not None else -1, r.content) for r in got) == [("-", -1, "b."), ("-", 0, "a."), ("f", 0, ".")]
    assert len(list((tmp_path / "calls").iterdir())) == 3


def test_compaction_keeps_every_answer(spark, tmp_path):
    state, calls = tmp_path / "s", tmp_path / "calls"
    calls.mkdir()
    for n in (20, 40):
        connectors.ask_missing(questions(spark, n, 4), str(state), "", Counted(calls), steps=8)
    before, files = sorted(map(str, connectors.read_answers(spark, str(state)).collect())), len(list(state.rglob("*.parquet")))
    connectors.compact_answers(spark, str(state))
    assert sorted(map(str, connectors.read_answers(spark, str(state)).collect())) == before and len(list(state.rglob("*.parquet"))) < files
    assert connectors.call_once(questions(spark, 40), str(state), "", Counted(calls), steps=8).count() == 40 and len(list(calls.iterdir())) == 40


def test_steps_and_calls_reach_the_stages(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    docs = spark.createDataFrame([(f"{k}.md", "Ã" * 50 + f" texto {k}") for k in range(6)], "file_name string, text string")
    out = stages.run_all(source=docs, state=str(tmp_path / "s"), backend=Counted(calls), date="2026-01-01", steps=3, in_flight=4, attempts=2)
    assert out.count() == out.count() == 6 and len(list(calls.iterdir())) == 6
    assert {p.name for p in (tmp_path / "s").iterdir()} == {"refine", "build"}


def test_secret_and_prompt(spark, tmp_path, monkeypatch):
    (tmp_path / ".env").write_text("# a\nexport OTHER=1\nMODEL_KEY = 'k2'\n")
    monkeypatch.setenv("MODEL_KEY", "k1")
    assert connectors.secret("MODEL_KEY", str(tmp_path / ".env")) == "k1"
    monkeypatch.delenv("MODEL_KEY")
    assert connectors.secret("MODEL_KEY", str(tmp_path / ".env")) == "k2" and "k2" not in repr(connectors.Http("u", "k2", ["m"]))
    with pytest.raises(KeyError):
        connectors.secret("NONE_SUCH", str(tmp_path / ".env"))
    (tmp_path / "p.md").write_text("Eres un corrector.\n\nReglas:\n")
    assert connectors.read_prompt(spark, str(tmp_path / "p.md")) == "Eres un corrector.\n\nReglas:\n"


# --- assembly


def answers(spark, rows, folder, k):
    spark.createDataFrame(rows, assembly.ANSWERS).coalesce(1).write.parquet(str(folder / f"b{k}"))


def run(spark, tmp_path, patience=3600.0):
    stream = assembly.assembled(assembly.watch_answers(spark, str(tmp_path / "in"), 1), patience_s=patience)
    assembly.write_assembled(stream, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    return spark.read.parquet(str(tmp_path / "out")).collect()


def test_answers_in_any_order_over_three_batches(spark, tmp_path):
    rng = random.Random(3)
    sizes = {f"f{k}": rng.randint(1, 6) for k in range(12)}
    rows = [(f, i, n, f"texto {f} {i}", i, 2 * i, f"m{i}", None) for f, n in sizes.items() for i in range(n)]
    rows += rng.sample(rows, 5)  # answers that come twice
    rows += [("f1", 0, sizes["f1"], None, 0, 0, None, "TimeoutError: no answer")]
    rng.shuffle(rows)
    for k in range(3):
        answers(spark, rows[k::3], tmp_path / "in", k)
        got = run(spark, tmp_path)  # each run goes on from the checkpoint
    whole = {r[0]: r for r in got}
    assert len(got) == len(whole) == len(sizes)
    for f, n in sizes.items():
        assert (whole[f].text, whole[f].chunks, whole[f].tokens_in, whole[f].tokens_out, whole[f].model, whole[f].missing) == ("\n\n---\n\n".join(f"texto {f} {i}" for i in range(n)), n, n * (n - 1) // 2, n * (n - 1), f"m{n - 1}", [])
    answers(spark, [rows[0]], tmp_path / "in", 9)
    assert len(run(spark, tmp_path)) == len(sizes)


def test_what_is_stuck_is_reported_and_may_still_come(spark, tmp_path):
    answers(spark, [("a", 0, 3, "uno", 1, 1, "m", None), ("a", 2, 3, None, 0, 0, None, "ValueError: x")], tmp_path / "in", 0)
    assert run(spark, tmp_path, 0.5) == []
    time.sleep(1)
    answers(spark, [("b", 0, 1, "solo", 1, 1, "m", None)], tmp_path / "in", 1)
    got = {r.file_name: r for r in run(spark, tmp_path, 0.5)}
    assert (got["a"].state, got["a"].missing, got["b"].state) == ("STUCK", [1, 2], "COMPLETE")
    answers(spark, [("a", 1, 3, "dos", 1, 1, "m", None), ("a", 2, 3, "tres", 1, 1, "m", None)], tmp_path / "in", 2)
    assert sorted((r.file_name, r.state, r.text) for r in run(spark, tmp_path, 0.5)) == [("a", "COMPLETE", "uno\n\n---\n\ndos\n\n---\n\ntres"), ("a", "STUCK", None), ("b", "COMPLETE", "solo")]


def test_stream_equals_batch_and_asks_once(spark, tmp_path):
    calls, folder = tmp_path / "calls", tmp_path / "docs"
    calls.mkdir()
    folder.mkdir()
    texts = {f"d{k}.md": "Ã" * 50 * (1 + 40 * (k % 2)) + " " + " ".join(f"palabra{k} {i}" for i in range(7000 * (k % 2) + 5)) for k in range(4)} | {"limpio.md": "Un texto limpio."}
    from docprep.streaming.incremental import watch_markdown

    def go():
        assembly.ask_new(watch_markdown(spark, str(folder)).select("file_name", "text"), str(tmp_path / "in"), str(tmp_path / "asked"), backend=Counted(calls), in_flight=4).awaitTermination()
        return {r.file_name: r for r in run(spark, tmp_path)}

    for name, text in texts.items():
        (folder / name).write_text(text)
    got = go()
    n = len(list(calls.iterdir()))
    assert n == 2 + 2 * 3 and {r.chunks for r in got.values()} == {1, 3}
    batch = {r.file_name: r for r in stages.refine(spark.createDataFrame(list(texts.items()), "file_name string, text string"), backend=Counted(tmp_path)).collect()}
    assert {f: (r.text, r.chunks, r.tokens_in) for f, r in got.items()} == {f: (r.text, r.chunks, r.tokens_in) for f, r in batch.items() if r.status != "COPY"}
    go()
    assert len(list(calls.iterdir())) == n
    import shutil

    shutil.move(tmp_path / "asked", tmp_path / "lost")  # even without its checkpoint it asks for nothing twice
    go()
    assert len(list(calls.iterdir())) == n
