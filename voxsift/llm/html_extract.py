"""Main text of web pages with a tree-structured graphical model.

Each block element of a page is a variable: content or not. A node potential
weighs its tag, the words of its class, id and role, and its text; parent-child
potentials tie elements to the one they stand in. The graph is a tree, so
messages passed upward and downward once give the exact content marginal of
every element, and text is kept where the marginal is above one half.

The potentials are fitted to labelled pages: pages that mark exactly one article
label their own elements, inside or outside it. A bounded sample of pages is
enough, chosen by a hash of their ids. Weights are drawn towards a prior, which
speaks for tags and names that the labelled pages do not show.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .html_tree import Page, features, parse

TRAINING_PAGES = 400
PRIOR_STRENGTH = 4.0  # of the pull towards the prior weights, against the mean loss times labelled pages

#: Prior weights of tags.
_TAGS = {
    "article": 5.0, "main": 6.5, "p": 1.3, "blockquote": 1.0, "pre": 1.0, "h1": 1.0, "h2": 0.7, "h3": 0.7, "h4": 0.5,
    "section": 0.8, "figcaption": 0.3, "nav": -6.0, "footer": -6.0, "aside": -7.0, "form": -7.0, "header": -2.5,
    "menu": -6.0, "button": -6.0, "select": -6.0, "textarea": -6.0, "fieldset": -4.0, "dialog": -6.0, "address": -1.0,
    "head": -8.0, "canvas": -4.0, "audio": -4.0, "video": -4.0, "object": -4.0, "body": -1.5, "html": -1.5, "page": -1.0,
}
#: Prior weights of words in class, id and role.
_WORDS = {
    weight: words.split() for weight, words in {
        4.0: "article content main story entry post articlebody maincontent",
        1.5: "body text prose copy chapter page",
        -8.0: "ad ads advert advertisement adverts sponsor sponsored promo promotion banner nav navigation navbar menu"
              " sidebar footer masthead cookie cookies consent gdpr notice popup modal overlay newsletter subscribe signup"
              " login comment comments reply replies disqus respond reactions discussion related recommended recommendations"
              " share sharing social breadcrumb breadcrumbs pagination pager widget toolbar search form complementary"
              " contentinfo alert toast skip paywall outbrain taboola teaser teasers",
        -2.5: "header top bottom meta tags author byline links list aside info copyright legal disclaimer rating",
    }.items()
}
_PRIOR = (
    {"bias": -0.5, "log length": 0.6, "link share": -3.0, "stops": 1.0}
    | {"tag " + tag: weight for tag, weight in _TAGS.items()}
    | {"word " + word: weight for weight, words in _WORDS.items() for word in words}
)
#: Prior ties of (parent, child), in hundredths: not-not, not-content, content-not, content-content.
_PRIOR_TIES = ((95.0, 5.0), (5.0, 95.0))


class Model(NamedTuple):
    weights: dict[str, float]
    ties: tuple[tuple[float, float], tuple[float, float]]  # P(child | parent)


def default_model() -> Model:
    return Model(_PRIOR, tuple(tuple(x / sum(row) for x in row) for row in _PRIOR_TIES))


def marginals(page: Page, model: Model) -> list[float]:
    """P(content) of each node, by one upward and one downward pass of messages.

    All messages are ratios content : not. A node comes behind its parent in
    the list, so the passes are the list backwards and forwards.
    """
    weights, ((t00, t01), (t10, t11)) = model.weights, model.ties
    below, upward = [], [1.0] * len(page.nodes)
    for own in features(page):
        score = sum(weights.get(name, 0.0) * value for name, value in own)
        below.append(math.exp(max(-30.0, min(30.0, score))))
    for n in range(len(below) - 1, 0, -1):
        ratio = min(below[n], 1e30)
        upward[n] = (t10 + t11 * ratio) / (t00 + t01 * ratio)
        below[page.nodes[n].parent] *= upward[n]
    belief = [min(below[0], 1e60)]
    for n in range(1, len(below)):
        rest = belief[page.nodes[n].parent] / upward[n]
        belief.append(min(below[n] * (t01 + t11 * rest) / (t00 + t10 * rest), 1e60))
    return [ratio / (1.0 + ratio) for ratio in belief]


def extract(source: str, model: Model) -> list[str]:
    """The blocks of main text, in page order."""
    page = parse(source)
    content = marginals(page, model) if page.blocks else []
    return [text for node, text, _ in page.blocks if content[node] > 0.5]


def labels(page: Page) -> list[int] | None:
    """1 for each node inside the page's only article, 0 outside it. None if the page does not mark one.

    -1, unknown, for what may stand in an article without being its text: menus, forms and elements named like comments
    or adverts, with all they hold. Nothing is learnt from these, so the fit does not only repeat its prior.
    """
    if sum(node.tag == "article" for node in page.nodes) != 1:
        return None
    unsure = ("nav", "footer", "aside", "form", "button", "select")
    told: list[int] = []
    for node in page.nodes:
        above = told[node.parent] if node.parent >= 0 else 0
        if above == 1 and (node.tag in unsure or any(_PRIOR.get("word " + w, 0) <= -8 for w in node.words)):
            above = -1
        told.append(1 if node.tag == "article" else above)
    return told


def fit(pages: list[str], strength: float = PRIOR_STRENGTH, rounds: int = 60) -> Model:
    """Potentials from those of the pages that label themselves; the prior if none does.

    Ties: shares of labels among children by the label of the parent, half
    counted and half prior. Node weights: pseudo-likelihood, that is logistic loss
    given the label of the parent, with a Gaussian prior around the given weights.
    """
    rows, truth, above, ties = [], [], [], np.zeros((2, 2))
    for source in pages:
        page = parse(source)
        told = labels(page)
        if told is None:
            continue
        known = [n for n, label in enumerate(told) if label >= 0]  # with all that they stand in
        own = features(page)
        rows += [own[n] for n in known]
        truth += [told[n] for n in known]
        above += [told[max(page.nodes[n].parent, 0)] for n in known]
        for n in known[1:]:
            ties[told[page.nodes[n].parent], told[n]] += 1
    if not rows:
        return default_model()
    names = sorted({name for own in rows for name, _ in own})
    place = {name: k for k, name in enumerate(names)}
    x = np.zeros((len(rows), len(names)))
    for n, own in enumerate(rows):
        for name, value in own:
            x[n, place[name]] = value
    y, prior = np.array(truth, float), np.array([_PRIOR.get(name, 0.0) for name in names])
    w, pull = prior.copy(), strength * len(pages) / 10
    # half counted, half prior
    ties = ties / np.maximum(ties.sum(axis=1, keepdims=True), 1) + np.array(default_model().ties)
    ties = ties / ties.sum(axis=1, keepdims=True)
    # what the parent says is not said again by the node's own weights
    known = np.log(ties[above, 1] / ties[above, 0])
    for _ in range(rounds):  # Newton steps: the loss is convex
        p = 1 / (1 + np.exp(-np.clip(x @ w + known, -30, 30)))
        slope = x.T @ (p - y) + pull * (w - prior)
        curve = (x * (p * (1 - p))[:, None]).T @ x + pull * np.eye(len(names))
        step = np.linalg.solve(curve, slope)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return Model(_PRIOR | dict(zip(names, w.tolist())), tuple(map(tuple, ties.tolist())))


def trained(pages: DataFrame, most_pages: int = TRAINING_PAGES) -> Model:
    """The model fitted to at most ``most_pages`` pages with an article, the first by a hash of page_id and url."""
    drawn = pages.where(F.col("html").contains("<article")).select(F.xxhash64("page_id", "url").alias("drawn"), "html")
    # the draws alone first: each task would send as many pages as are wanted in all
    first = [row["drawn"] for row in drawn.select("drawn").orderBy("drawn").limit(most_pages).collect()]
    if not first:
        return default_model()
    drawn = drawn.where(F.col("drawn") <= first[-1]).orderBy("drawn", F.sha1(F.col("html").cast("binary"))).limit(most_pages)
    return fit([row["html"] for row in drawn.collect()])


def main_text(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """Per page its main text: page_id, url, text, n_chars.

    Character references are decoded, white space in a block is one blank, and
    blocks are joined by a line end. Null and empty pages, and pages without
    content, have an empty text. Repeated rows stay; other columns are not read.
    """
    model = trained(pages) if model is None else model

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ["\n".join(extract(source.as_py() or "", model)) for source in batch.column(2)]
            # references to lone surrogates cannot be UTF-8
            texts = [text if text.isascii() else text.encode("utf-8", "replace").decode() for text in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html").mapInArrow(
        read, "page_id long, url string, text string, n_chars long"
    )
