"""Labelling, features and preprocessing as Spark ML estimators, for use in a ``Pipeline`` and to be saved with it.

Each estimator fits with the functions of the module that does the work; its model holds the fitted tables and is saved as a bundle.
"""

from __future__ import annotations

from dataclasses import asdict

from pyspark import keyword_only
from pyspark.ml import Estimator, Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingguard.config import LabelRules
from listingguard.operators import features as fe
from listingguard.operators import labelling as lab
from listingguard.operators.bundle import BundleModel


class _HasRules(Params):
    """``rules``: the fields of LabelRules that differ from their defaults."""

    rules = Param(Params._dummy(), "rules", "cut points that differ from the defaults, by name")

    def label_rules(self) -> LabelRules:
        return LabelRules(**self.getOrDefault("rules"))


class RuleLabeller(Estimator, _HasRules, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the price statistics; its model adds the rule flags, ``fraud_score`` and ``is_fraud``."""

    @keyword_only
    def __init__(self, *, rules: dict | None = None) -> None:
        super().__init__()
        self._setDefault(rules={})
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> RuleLabelModel:
        return self._copyValues(RuleLabelModel(lab.fit_labels(dataset, self.label_rules())))


class RuleLabelModel(BundleModel, _HasRules):
    def __init__(self, stats: lab.LabelStats | None = None) -> None:
        super().__init__()
        self._setDefault(rules={})
        self.stats = stats

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return lab.apply_labels(dataset, self.stats, self.label_rules())

    def _facts(self):
        s = self.stats
        return {"price_clip": s.price_clip, "size_clip": s.size_clip, "national_median": s.national_median}

    def _tables(self):
        return {"city": self.stats.city, "state": self.stats.state}

    @classmethod
    def _restored(cls, facts, tables, parts):
        return cls(lab.LabelStats(**facts, city=tables["city"], state=tables["state"]))


class PlaceFeatures(Estimator, _HasRules, DefaultParamsReadable, DefaultParamsWritable):
    """Fits medians, counts and label rates per place; its model adds the fold-dependent features."""

    labelCol = Param(Params._dummy(), "labelCol", "label column of the training rows", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, labelCol: str = "is_fraud", rules: dict | None = None) -> None:
        super().__init__()
        self._setDefault(labelCol="is_fraud", rules={})
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> PlaceFeaturesModel:
        return PlaceFeaturesModel(fe.fit_features(dataset, self.getOrDefault("labelCol"), self.label_rules()))


class PlaceFeaturesModel(BundleModel):
    def __init__(self, stats: fe.FeatureStats | None = None) -> None:
        super().__init__()
        self.stats = stats

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return fe.apply_features(dataset, self.stats)

    def _facts(self):
        return {"by": list(self.stats.by)}

    def _tables(self):
        s = self.stats
        return {"city": s.city, "state": s.state, "zip_code": s.zip_code, "fallback": s.fallback}

    @classmethod
    def _restored(cls, facts, tables, parts):
        return cls(fe.FeatureStats(tuple(facts["by"]), **tables))


class RowFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the features that need no fit."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return fe.stateless_features(dataset)


class ListingVector(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Fits imputation, scaling and encoding; its model adds ``features``, the ordered model inputs."""

    def _fit(self, dataset: DataFrame) -> ListingVectorModel:
        return ListingVectorModel(fe.fit_preprocessor(dataset))


class ListingVectorModel(BundleModel):
    def __init__(self, prep: fe.Preprocessor | None = None) -> None:
        super().__init__()
        self.prep = prep

    def _transform(self, dataset: DataFrame) -> DataFrame:
        inputs = [*self.prep.numeric, *self.prep.categorical]
        ready = fe.preprocess(dataset, self.prep)
        return ready.withColumn("features", array_to_vector(F.array(*[F.col(c).cast("double") for c in inputs])))

    def _facts(self):
        p = self.prep
        return {"by": list(p.by), "numeric": list(p.numeric), "categorical": list(p.categorical)}

    def _tables(self):
        codes = {f"codes_{c}": t for c, t in self.prep.codes.items()}
        return {"numbers": self.prep.numbers, "modes": self.prep.modes, **codes}

    @classmethod
    def _restored(cls, facts, tables, parts):
        names = {k: tuple(v) for k, v in facts.items()}
        codes = {c: tables[f"codes_{c}"] for c in names["categorical"]}
        return cls(fe.Preprocessor(**names, numbers=tables["numbers"], modes=tables["modes"], codes=codes))


def changed_rules(rules: LabelRules) -> dict:
    """The ``rules`` parameter that stands for ``rules``."""
    usual = asdict(LabelRules())
    return {k: v for k, v in asdict(rules).items() if v != usual[k]}
