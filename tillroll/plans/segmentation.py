"""From the feature table to labelled members, group profiles and files."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tillroll.operators import clustering as cl
from tillroll.operators import prepare as pr
from tillroll.operators import profile as pf
from tillroll.session import materialize


@dataclass
class Prepared:
    """Encoded rows of one category, the columns to cluster by, and the codes to decode."""

    rows: DataFrame
    columns: list[str]
    categorical: list[str]
    codes: DataFrame
    coded: list[str]


@dataclass
class Segmentation:
    """Result of a run."""

    detail: DataFrame
    scores: DataFrame | None
    k: int
    numeric: list[str]
    options: pr.Options

    def sizes(self) -> DataFrame:
        return pf.group_size(self.detail)

    def describe(self) -> DataFrame:
        return pf.group_describe(self.detail, self.numeric)

    def mean_std(self) -> DataFrame:
        return pf.group_mean_std(self.detail, self.numeric)

    def shares(self) -> DataFrame:
        texts = [c for c, t in self.detail.dtypes if t == "string" and c not in pr.IDS]
        return pf.value_share(self.detail, texts)

    def summary(self) -> DataFrame:
        how = f"Auto/{self.options.score}" if self.options.auto else "Manual"
        parameters = {
            "method": f"{self.options.method}/{how}",
            "features": ",".join(self.options.group_names()),
            "groups": str(self.k),
        }
        return pf.run_summary(self.detail, parameters)


def prepare(features: DataFrame, code: str, options: pr.Options) -> Prepared:
    """Select, fill, level and encode the rows of one category; they are written once."""
    groups = options.group_names()
    with_rfm = "rfm" in groups
    rows = pr.fill_missing(pr.one_category(pr.select_features(features, groups), code))
    if with_rfm:
        rows = pr.rfm_levels(rows, options.rfm_split, options.rfm_letters)
    coded = pr.text_columns(rows)
    codes = pr.label_codes(rows, coded)
    encoded = materialize(pr.encode_labels(rows, codes, coded)) if coded else materialize(rows)
    columns = pr.clustering_columns(encoded, with_rfm)
    if options.weight is not None:
        pr.require_columns(encoded, [options.weight])
    return Prepared(encoded, columns, coded, codes, coded)


Fits = dict[int, tuple[DataFrame, float]]


def fitter(data: Prepared, options: pr.Options) -> Callable[[list[int]], Fits]:
    """The chosen method as a function from several k to labelled rows and costs.

    K-modes, K-prototypes and K-means from given starting rows move all k in the same rounds; K-medoids and
    K-means from Spark's parallel start are fitted one k after the other.
    """
    rows, columns = data.rows, data.columns
    numeric = [c for c in columns if c not in data.categorical]
    common = {"max_iter": options.max_iter, "seed": options.seed, "restarts": options.restarts}
    if options.init is not None:
        common["init"] = options.init

    def labelled(models: dict[int, cl.Centres]) -> Fits:
        return {k: (m.label(rows), m.cost) for k, m in models.items()}

    def fit(ks: list[int]) -> Fits:
        if options.method in ("KMeans", "WKMeans"):
            weight = options.weight if options.method == "WKMeans" else None
            if options.init not in (None, "parallel") and not options.scale:
                return labelled(cl.kmeans_grid(rows, columns, ks, weight=weight, **common))
            return {k: cl.kmeans(rows, columns, k, weight=weight, scale=options.scale, **common)[:2] for k in ks}
        if options.method == "KModes":
            return labelled(cl.kmodes_grid(rows, columns, ks, **common))
        if options.method == "KPrototypes":
            return labelled(cl.kprototypes_grid(rows, numeric, data.categorical, ks, **common))
        return labelled({k: cl.kmedoids(rows, columns, k, **common) for k in ks})

    return fit


def segment(features: DataFrame, code: str, options: pr.Options) -> Segmentation:
    """Run one segmentation: prepare, choose k, fit, decode."""
    data = prepare(features, code, options)
    fit = fitter(data, options)
    scores, k = None, options.k
    if options.auto:
        fits = fit(list(range(options.k_min, options.k_max + 1)))
        scores = cl.score_grid(fits, data.columns, features.sparkSession, options.score == "silhouette")
        chosen = {r["metric"]: r["best_k"] for r in cl.best_k(scores).collect()}
        k = chosen[options.score]
        labelled, _ = fits[k]
    else:
        labelled, _ = fit([k])[k]
    detail = materialize(pr.decode_labels(labelled, data.codes, data.coded))
    numeric = [
        c for c, t in detail.dtypes if t != "string" and c not in [*pr.IDS, "label", *data.coded]
    ]
    return Segmentation(detail, scores, k, numeric, options)
