import hashlib

import corpus_pipeline
import public_tokenizers
from llm_cases import documents
from test_decontaminate import brute as contaminated
from test_line_dedup import brute as cut
from test_minhash import brute as components
from tokenizers import Tokenizer

from orderlens.llm import quality_rules


def base(seed, n):
    return [f"word{seed}x{i} the of" for i in range(n)]


ITEMS = [(1, " ".join(f"question{i}" for i in range(20)))]


def corpus():
    lines = base(1, 60)
    passage = "\n".join(f"shared line {k} with the words of a passage" for k in range(8))
    near = " ".join(f"near{i} of" for i in range(120))
    return [
        (1, " ".join(base(0, 40))),
        (2, "short"),
        (3, None),
        (4, "\n".join(lines + lines[:18])),
        (5, "\n".join(base(2, 30)) + "\n" + passage),
        (6, passage + "\n" + "\n".join(base(3, 30))),
        (7, near),
        (8, near + " changed"),
        (9, " ".join(base(4, 30)) + " " + ITEMS[0][1]),
        (10, "\n".join(base(2, 30)) + "\n" + passage),
        (11, " ".join(f"junk{i} | #" for i in range(80))),
    ]


def test_pipeline_matches_brute_force(spark, folder):
    docs = documents(spark, corpus())
    path = folder(
        documents=docs,
        benchmark=spark.createDataFrame(ITEMS, "item_id long, text string"),
    )
    kept = {
        r.doc_id
        for r in quality_rules.judge(docs).filter("kept").select("doc_id").collect()
    }
    assert kept == {1, 4, 5, 6, 7, 8, 9, 10}
    data = [(i, t) for i, t in corpus() if i in kept]
    data = [(i, new) for (i, _), (new, _) in cut(data, 50).items()]
    data = [(i, t) for (i, t), c in zip(sorted(data), sorted(components(data, 80))) if c[3]]
    expected = {}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for i, text in data:
        n, hit, _, _ = contaminated(text, ITEMS)
        if not (hit and 20 * len(hit) >= n):
            ids = library.encode(text, add_special_tokens=False).ids
            decoded = library.decode(ids, skip_special_tokens=False)
            expected[i] = (len(ids), ids, hashlib.sha256(decoded.encode()).hexdigest())
    assert set(expected) == {1, 4, 5, 6, 7, 10}
    found = corpus_pipeline.run(spark, path).collect()
    assert {r.doc_id: (r.n_tokens, r.ids, r.decoded_sha256) for r in found} == expected
    assert len(found) == len(expected)


def test_stages_return_the_columns_of_documents(spark, folder):
    docs = documents(spark, corpus())
    path = folder(benchmark=spark.createDataFrame(ITEMS, "item_id long, text string"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.dtypes == docs.dtypes
    assert [stage(spark, docs.limit(0), path).count() for _, stage in corpus_pipeline.STAGES] == [0] * 5
