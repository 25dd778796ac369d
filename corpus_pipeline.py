"""Documents to training shards: toxic texts out, one of each near copy, no benchmark text, sources to weight, token ids."""

from __future__ import annotations

import os
import sys

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from lathe.llm import op02_mixing, op03_toxicity, op05_jaccard, op07_binary, op08_decontam  # noqa: E402
from lathe.llm.common import cut, table  # noqa: E402
from lathe.llm.queries import crc_mod, vocabulary  # noqa: E402


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text scores below 0.5; the model learns from the labelled rows that op3's query learns from."""
    model = op03_toxicity.fit(docs, table(spark, sf_dir, "labels"), crc_mod("id", 5) != 0)
    return op03_toxicity.clean(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group of linked texts."""
    return op05_jaccard.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of the benchmark."""
    return op08_decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows times their source's draws, in shuffled order."""
    return op02_mixing.mixed(docs).select(*[F.col(f"`{c}`") for c in docs.columns])


def training_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of text in a fixed-length sequence, read back from the shards."""
    manifest, layout = op07_binary.write_shards(docs, vocabulary("byte_bpe_50k.tiktoken"))
    return op07_binary.read_shards(manifest, layout)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("training_shards", training_shards),
]

#: SQL can't express the trained classifier, the alignment or the token ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
