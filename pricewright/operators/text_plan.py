"""The text feature block: embeddings, statistics, sentiment and the missing-hashtags flag."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from pricewright.functions.text import is_missing, text_stats
from pricewright.operators.text_features import BagOfWords, BagOfWordsModel, Reduce, ReduceModel, sentiment
from pricewright.vocab import TEXT_COLUMNS, VALENCES


@dataclass
class TextPlan:
    """Which text features are made, and how texts become vectors."""

    text_cols: list[str] = field(default_factory=lambda: list(TEXT_COLUMNS))
    use_stats: bool = True
    use_embeddings: bool = True
    use_sentiment: bool = True
    use_missing_hashtags: bool = True
    vectorizer_class: str = "count"
    vectorizer_params: dict = field(default_factory=lambda: {"ngram_range": (1, 2), "max_features": 5000})
    reducer_class: str = "pca"
    reducer_params: dict = field(default_factory=lambda: {"n_components": 100})
    lexicon: dict[str, float] = field(default_factory=lambda: dict(VALENCES))

    def __post_init__(self):
        # made here so that an unknown name fails before any job runs
        self._vectorizer = BagOfWords(self.vectorizer_class, **self.vectorizer_params)
        self._reducer = Reduce(self.reducer_params.get("n_components", 100), self.reducer_class)

    def fit(self, df: DataFrame) -> "TextPlanModel":
        vectors, reductions = {}, {}
        if self.use_embeddings:
            for c in self.text_cols:
                vectors[c] = self._vectorizer.fit(df, c)
                reductions[c] = self._reducer.fit(vectors[c].transform(df.select(c), "__v"), "__v")
        return TextPlanModel(self, vectors, reductions)


class TextPlanModel:
    def __init__(self, plan: TextPlan, vectors: dict[str, BagOfWordsModel], reductions: dict[str, ReduceModel]):
        self.plan, self.vectors, self.reductions = plan, vectors, reductions

    def transform(self, df: DataFrame, output: str = "text_features") -> DataFrame:
        """One feature vector: embeddings, statistics, sentiment, missing-hashtags flag."""
        columns, plan, pieces = df.columns, self.plan, []
        for c in self.vectors:
            df = self.vectors[c].transform(df, "__v")
            df = self.reductions[c].transform(df, "__v", f"__pc_{c}").drop("__v")
            pieces.append(vector_to_array(f"__pc_{c}"))
        if plan.use_stats:
            for c in plan.text_cols:
                df = df.withColumn(f"__stats_{c}", text_stats(F.col(c)))
                pieces.append(
                    F.array(*[F.col(f"__stats_{c}.{s}").cast("double") for s in ("avg_word_length", "length", "num_words")])
                )
        if plan.use_sentiment:
            pieces.append(F.array(sentiment(F.col("description"), plan.lexicon)))
        if plan.use_missing_hashtags:
            pieces.append(F.array(is_missing(F.col("hashtags")).cast("double")))
        if not pieces:
            raise ValueError("the text plan makes no feature")
        return df.select(*columns, array_to_vector(F.concat(*pieces)).alias(output))
