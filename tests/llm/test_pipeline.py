import hashlib
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
from starmart.llm.mixing import BUDGET, POWERS
from starmart.llm.quality_rules import quality_rules

from test_decontamination import brute as decontaminated
from test_jaccard_join import brute as components
from test_mixing import brute_probabilities, brute_weights

SF = "/root/testdata/sf0.001"


def topic(t):
    if " | " in t or "!! " in t:
        return "marked"
    if any(t[i:i + 3].isdigit() and t[i:i + 3].isascii() for i in range(len(t) - 2)):
        return "figures"
    return "short" if len(t.encode()) < 1000 else "prose"


def draw(d, t):
    inner = hashlib.md5(t.encode()).hexdigest()
    return int(hashlib.md5(f"{d}:{inner}".encode()).hexdigest()[:13], 16) / 2 ** 52


def test_run_equals_brute_force(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    docs = {r.doc_id: r for r in frame.collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    # the verdict itself is tested against labels and brute-force counts in test_quality_rules
    docs = {r.doc_id: docs[r.doc_id] for r in quality_rules(frame).collect() if r.kept}
    docs = {d: docs[d] for d, n, c in components([(d, r.text) for d, r in docs.items()]) if n == 0 or c == d}
    docs = {d: docs[d] for d, _, hit, _ in decontaminated([(d, r.text) for d, r in docs.items()], items, 10) if not hit}
    cells = defaultdict(float)
    key = {d: ("=" + r.source, "=" + r.lang, topic(r.text)) for d, r in docs.items()}
    for d, r in docs.items():
        cells[key[d]] += len(r.text.encode().split())
    p = brute_probabilities(cells, brute_weights(cells, [POWERS["source"], POWERS["lang"], POWERS["topic"]], 400), BUDGET)
    docs = {d: r for d, r in docs.items() if draw(d, r.text) < p[key[d]]}

    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in got} == {
        d: (len(r.text.encode()) + 1, zlib.crc32(r.text.encode())) for d, r in docs.items()}
    held = Counter()
    for r in got:
        held[r.shard] += r.size
    assert len(got) == len(docs) and len(held) == corpus_pipeline.SHARDS
    assert max(held.values()) <= max(1.1 * sum(held.values()) / len(held), max(r.size for r in got) + min(held.values()))


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "jaccard_join", "decontamination", "mixing", "sharding"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SF).count() == 0
