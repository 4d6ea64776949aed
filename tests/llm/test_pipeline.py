"""The whole pipeline over planted rows: what must go goes, clean documents stay, and each stage works on what the one before it kept."""

import random

import corpus_pipeline
import pytest
from tokenizers import Tokenizer

from factloom.llm.common import read_table
from factloom.llm.queries import tokenizer_path

SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality int, toxic int",
    "benchmark": "item_id long, text string",
}
PLAIN = [f"{a}{b}{c}" for a in ("ba", "co", "di", "fu", "ge", "hy") for b in ("ran", "lim", "tos", "pek") for c in ("", "ed", "ing", "s", "ly")]
SECRET = "api_key=Zx81kQp02LmN77ty"


def planted():
    """Tables, and the texts that must be left by doc_id."""
    rng = random.Random(11)
    text = lambda n: " ".join(rng.choice(PLAIN) for _ in range(n))
    items = [text(45) for _ in range(6)]
    kept = {k: text(rng.randrange(30, 90)) for k in range(240)}
    texts, labels = dict(kept), {k: 0 for k in range(0, 240, 2)}
    for k in range(300, 380):
        texts[k] = " ".join(rng.choice(["zorgle", "kwimp", "vrask"]) if rng.random() < 0.4 else rng.choice(PLAIN) for _ in range(50))
        if k < 360:
            labels[k] = 1
    for k in range(400, 410):
        texts[k] = kept[k - 400]
    long = kept[239] = texts[239] = text(400)
    texts[410] = " ".join(["other", *long.split()[1:]])
    for k in range(6):
        texts[420 + k] = f"{text(20)} {items[k]} {text(20)}"
    hidden = items[0].split()
    hidden[20] = "substituted"
    texts[426] = f"{text(30)} {' '.join(hidden)}"
    for k in range(430, 436):
        body = text(60)
        texts[k], kept[k] = f"{body} {SECRET} after", None
    texts[440] = None
    return texts, labels, items, kept


def written(spark, folder, texts, labels, items):
    rows = {
        "documents": [(k, t, "en", "src0" if k % 3 else "hot", len(t or "")) for k, t in texts.items()],
        "labels": [(k, 1, v) for k, v in labels.items()],
        "benchmark": list(enumerate(items)),
    }
    for name, own in rows.items():
        spark.createDataFrame(own, SCHEMAS[name]).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    texts, labels, items, kept = planted()
    sf_dir = written(spark, tmp_path_factory.mktemp("planted"), texts, labels, items)
    left, docs = {}, read_table(spark, sf_dir, "documents")
    for name, stage in corpus_pipeline.STAGES:
        columns, docs = docs.columns, corpus_pipeline.materialise(stage(spark, docs, sf_dir))
        left[name] = docs
        assert name == "packing" or docs.columns == columns
    return texts, kept, left, sf_dir


def ids(frame):
    return {r.doc_id for r in frame.select("doc_id").collect()}


def test_each_stage_drops_what_it_must_and_no_more(stages):
    texts, kept, left, _ = stages
    toxic, copies, leaks = set(range(300, 380)), set(range(400, 411)), set(range(420, 427))
    first, second, third = (ids(left[s]) for s in ("toxicity", "near_duplicates", "decontamination"))
    assert len(toxic & first) <= 4 and len(set(texts) - toxic - first) <= 2
    # of a document and its copy just one stays
    assert all(len({k, k - 400} & second) == 1 for k in range(400, 410) if k - 400 in first or k in first) and len({239, 410} & second) == 1
    assert first - second <= copies | {k - 400 for k in range(400, 410)} | {239} and len(first - second) == len(copies & first)
    assert second - third == leaks & second and leaks <= second
    assert ids(left["secrets"]) == third == ids(left["packing"])


def test_secrets_are_redacted_and_tokens_are_those_of_the_redacted_texts(stages):
    texts, _, left, _ = stages
    redacted = {r.doc_id: r.text for r in left["secrets"].collect()}
    assert all("Zx81kQp02LmN77ty" not in redacted[k] and redacted[k].endswith("after") for k in range(430, 436))
    assert all(redacted[k] == texts[k] for k in redacted if not 430 <= k < 436)
    tokenizer, lengths = Tokenizer.from_file(tokenizer_path()), {}
    for p in left["packing"].collect():
        lengths[p.doc_id] = lengths.get(p.doc_id, 0) + p.length
    assert lengths == {k: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for k, t in redacted.items()}


def test_run_is_all_stages_in_turn(spark, stages):
    _, _, left, sf_dir = stages
    rows = lambda frame: sorted(map(tuple, frame.select("doc_id", "start", "length", "ids_crc32", "doc_tokens").collect()))
    assert rows(corpus_pipeline.run(spark, sf_dir)) == rows(left["packing"])


def test_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, written(spark, tmp_path, {}, {}, [])).count() == 0
