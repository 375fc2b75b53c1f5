import hashlib

import corpus_pipeline as pipeline
import pandas as pd
import public_tokenizers as P
from llm_fixtures import HARD, make  # noqa: F401
from test_minhash import groups
from test_quality_rules import brute

from claimwise.llm import bpe
from claimwise.llm.common import stored

ORDER = ["language", "quality", "near_dedup", "mixture", "tokens"]


def test_stages_over_the_test_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, at = docs.columns, {"": docs.toPandas()}
    assert [n for n, _ in pipeline.STAGES] == ORDER
    for name, stage in pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"test-{name}")
        assert name == "tokens" or docs.columns == columns
        at[name] = docs.toPandas()
    assert len(at["language"]) == len(at[""])  # every text has letters and a clear language
    failed = {r.doc_id for r in at["language"].itertuples() if brute(r.text)[5]}
    kept = set(at["quality"]["doc_id"])
    assert not kept & failed and kept <= set(at["language"]["doc_id"])
    rows = [(r.doc_id, r.text) for r in at["quality"].itertuples()]
    assert sorted(at["near_dedup"]["doc_id"]) == [i for i, _, _, k in groups(rows, 5, 80) if k]
    text = dict(rows)
    assert all(set(r.text.split()) <= set(text[r.doc_id].split()) and r.n_chars == len(r.text) for r in at["mixture"].itertuples())
    ids = list(bpe.codec(P.path("byte_bpe_50k.json"), P.PATTERN).encode_batch(at["mixture"]["text"].tolist()))
    expected = sorted((r.doc_id, len(i), hashlib.sha256(r.text.encode()).hexdigest()) for r, i in zip(at["mixture"].itertuples(), ids, strict=True))
    assert sorted(zip(at["tokens"]["doc_id"], at["tokens"]["n_tokens"], at["tokens"]["decoded_sha256"], strict=True)) == expected
    assert isinstance(at["tokens"], pd.DataFrame)


def test_stages_survive_hard_rows_and_empty_tables(spark, make):
    for rows in (HARD, []):
        docs = make(rows)
        for name, stage in pipeline.STAGES:
            out = stage(spark, docs, "")
            assert out.count() <= 3 * len(rows) and (name == "tokens" or out.columns == docs.columns)


SWAHILI = ("Watu wote wamezaliwa huru, hadhi na haki zao ni sawa. Wote wamejaliwa akili na dhamiri, hivyo yapasa watendeane kindugu. Kila mtu anastahili "
           "kuwa na haki zote na uhuru wote ambao umeelezwa katika taarifa hii bila ya ubaguzi wo wote, kama vile wa rangi, taifa, wanaume na wanawake.")
RUSSIAN = ("Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и должны поступать в отношении "
           "друг друга в духе братства. Каждый человек должен обладать всеми правами и всеми свободами без какого бы то ни было различия.")
NONSENSE = "xqzv kjwq zzxv qqpk vwxz jqkx wvzq pqxj zkvw qxzj kkqz vjxw zqpv xwkj qvzx jzkq wqxv zvkp qjxz vkwz xzqp jvkq zxwv qkzj pvxq wzkj"


def test_unlearned_languages_and_nonsense_go_and_learned_ones_stay(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(10**6 + i, t, None, "x", len(t)) for i, t in enumerate([SWAHILI, RUSSIAN, NONSENSE, SWAHILI * 20, NONSENSE * 20, "12 34 !!", ""])]
    rows += [(None, NONSENSE, None, "x", 1)]
    planted = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    left = [r.doc_id for r in pipeline.language(spark, planted, sf_dir).select("doc_id").collect()]
    assert sorted(left) == sorted(r.doc_id for r in docs.select("doc_id").collect())
