"""Plain-language summaries: the prompt column plus an optional model hook."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.texts import NO_MODEL_TEXT

Model = Callable[[pd.Series], pd.Series]


def explain(df: DataFrame, model: Model | None = None, prompt: str = "prompt", out: str = "summary") -> DataFrame:
    """Add a summary per prompt: the fixed text, or what `model` returns for a batch of prompts.

    The model is called inside tasks on Arrow batches; set it up once per task in the callable.
    """
    if model is None:
        return df.withColumn(out, F.lit(NO_MODEL_TEXT))

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for prompts in batches:
            yield model(prompts)

    return df.withColumn(out, run(F.col(prompt)))
