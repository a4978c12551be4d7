"""Plug-in points for models that the package does not bundle.

A factory is called once per partition, so a model loads once per task and not once per row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipsieve import schemas
from clipsieve.operators.evidence import Detector

# Texts to one (language, confidence) each.
LanguageModel = Callable[[list[str]], Sequence[tuple[str, float]]]
# Texts to one vector each.
Encoder = Callable[[list[str]], np.ndarray]
# Texts to one list of (surface, model label, confidence or None) each.
EntityModel = Callable[[list[str]], Sequence[Sequence[tuple[str, str, float | None]]]]

# Model label -> entity type; other labels are left out.
MODEL_LABELS = {
    "PERSON": "PERSON",
    "ORG": "ORG_BRAND",
    "GPE": "GPE_LOC",
    "LOC": "GPE_LOC",
    "WORK_OF_ART": "WORK",
    "PRODUCT": "PRODUCT",
}
DEFAULT_MODEL_CONFIDENCE = 0.8


def language_detector(make_detect: Callable[[], LanguageModel]) -> Detector:
    """Make a detector column from a model over batches of texts. Empty text is ("unknown", 0.0)."""

    @F.pandas_udf(schemas.struct(lang=schemas.STRING, conf=schemas.DOUBLE))
    def guess(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        detect = make_detect()
        for texts in batches:
            full = [i for i, text in enumerate(texts) if text]
            pairs = [("unknown", 0.0)] * len(texts)
            for i, pair in zip(full, detect([texts.iloc[i] for i in full]) if full else []):
                pairs[i] = pair
            yield pd.DataFrame(pairs, columns=["lang", "conf"])

    # Not deterministic for the planner: the language filter is then not moved below the model, where
    # it would run it a second time.
    once = guess.asNondeterministic()

    def detector(desc: Column) -> Column:
        return once(desc)

    return detector


def encode(evidence: DataFrame, make_encoder: Callable[[], Encoder]) -> DataFrame:
    """Embeddings of the topic texts by a user-supplied encoder."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = make_encoder()
        for batch in batches:
            vectors = np.asarray(encoder(batch["topic_text"].tolist()), dtype=float)
            yield pd.DataFrame(
                {
                    "run_id": batch["run_id"],
                    "video_id": batch["video_id"],
                    "embedding": list(vectors),
                }
            )

    texts = evidence.select("run_id", "video_id", F.coalesce("topic_text", F.lit("")).alias("topic_text"))
    return texts.mapInPandas(run, schemas.EMBEDDINGS)


def with_model_entities(evidence: DataFrame, make_model: Callable[[], EntityModel]) -> DataFrame:
    """Add ``model_entities`` by a user-supplied model; ``candidates`` then uses them."""
    added = T.StructField("model_entities", schemas.MODEL_ENTITIES)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make_model()
        for batch in batches:
            found = model(batch["ner_text"].tolist())
            entities = [
                [
                    {
                        "surface": surface,
                        "type": MODEL_LABELS[label],
                        "confidence": DEFAULT_MODEL_CONFIDENCE if confidence is None else confidence,
                    }
                    for surface, label, confidence in items
                    if label in MODEL_LABELS
                ]
                for items in found
            ]
            yield batch.assign(model_entities=entities)

    needed = ["run_id", "video_id", "ner_text", "hashtags_list_raw", "hashtags_list_norm"]
    needed += [name for name in ("music_title", "poi_name") if name in evidence.columns]
    rows = evidence.select(*needed)
    return rows.mapInPandas(run, T.StructType(rows.schema.fields + [added]))
