import random
import sys
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from ledgerloom.llm import langid  # noqa: E402

from test_dedup import brute_classes, stripped  # noqa: E402
from test_leaks import cases, plain  # noqa: E402
from test_tokens import check_packing  # noqa: E402


def corpus():
    items, docs, _ = cases(9)
    rng = random.Random(10)
    texts = [t for _, t in docs]
    texts += [t.replace(" ", "\n", 1) for t in texts[:20]]
    for t in texts[20:40]:
        words = t.split()
        words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    texts += [None, "", "1234 %%"]
    rng.shuffle(texts)
    return items, list(enumerate(texts))


def test_pipeline_matches_brute_force(spark, tmp_path):
    items, rows = corpus()
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()

    model = langid.learn(docs)
    rejected = model.predict([t for _, t in rows])[2]
    left = [r for r, gone in zip(rows, rejected) if not gone]
    assert len(rows) - len(left) < 10
    best = {}
    for d, t in left:
        key = stripped(t)
        if key not in best or (-len(t), d) < (-len(best[key][1]), best[key][0]):
            best[key] = (d, t)
    left = sorted(best.values())
    classes = brute_classes(left)
    left = [r for k, r in enumerate(left) if not any(c == classes[k] for c in classes[:k])]
    found = {d for d, t in left for _, i in items if f" {plain(i)} " in f" {plain(t)} "}
    from test_leaks import distance_in

    leaks = {d for d, t in left if any(distance_in(plain(i), plain(t)) <= int(0.1 * len(plain(i))) for _, i in items)}
    assert found <= leaks
    check_packing(out, {d: t for d, t in left if d not in leaks}, 1024)


def test_stages_keep_the_columns(spark, tmp_path):
    items, rows = corpus()
    docs = spark.createDataFrame([(d, t, "en", "s", 1, "u") for d, t in rows[:40]], "doc_id long, text string, lang string, source string, n_chars long, uid string")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).schema == docs.schema
        assert stage(spark, docs.filter(F.lit(False)), str(tmp_path)).count() == 0


def test_every_operator_is_registered():
    names = entry.queries()
    assert [n for k in range(1, 14) for n in names if n.startswith(f"op{k}_")] == [n for n in names if n.startswith("op")]
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)
