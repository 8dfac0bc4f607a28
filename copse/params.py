"""Hyper-parameters of the booster."""

from __future__ import annotations

from dataclasses import dataclass, replace

METHODS = ("exact", "histogram", "quantile")


@dataclass(frozen=True)
class BoostParams:
    trees: int = 5
    depth: int = 8
    learning_rate: float = 0.4
    reg_lambda: float = 1.0
    gamma: float = 1.0
    """Flat cost taken off the gain of every split."""
    subsample_cols: float = 0.8
    subsample_rows: float | None = None
    """Share of rows kept for the fit; ``None`` keeps all."""
    method: str = "exact"
    num_bins: int = 3
    """Equal-width bins per node and feature for ``method='histogram'``."""
    eps: float = 0.5
    """Rank step of the candidate splits for ``method='quantile'``."""
    weighted: bool = False
    """Cuts of ``method='quantile'`` by sums of hessians, found anew for each tree, instead of by numbers of rows."""
    min_gain: float | None = None
    """A split needs a gain above this; ``None`` accepts any gain, negative ones too."""
    min_leaf: int | None = None
    """Fewest rows on either side of a split; ``None`` switches the rule off."""
    min_child_weight: float | None = None
    """Each side's hessian must exceed this; ``None`` switches the rule off."""
    train_margin: float | None = 0.5
    """Margin every row starts from while fitting; ``None`` starts from the log-odds."""
    score_margin: float = 0.0
    seed: int = 0

    def __post_init__(self) -> None:
        if self.method not in METHODS:
            raise ValueError(f"method must be one of {METHODS}")
        if not 0 <= self.depth <= 60:
            raise ValueError("depth must be between 0 and 60")
        if self.trees < 0:
            raise ValueError("trees must be >= 0")
        if self.method == "histogram" and self.num_bins < 1:
            raise ValueError("num_bins must be >= 1")
        if self.weighted and self.method != "quantile":
            raise ValueError("weighted cuts belong to method='quantile'")
        if self.method == "quantile" and not 0 < self.eps < 1:
            raise ValueError("eps must lie strictly between 0 and 1")

    def with_choice(self, choice: int) -> "BoostParams":
        """The split rule by number: 0, 1 and 2 search alike, 3 also asks for ``gain > 0``."""
        if choice not in (0, 1, 2, 3):
            raise ValueError("choice must be 0, 1, 2 or 3")
        return replace(self, method="exact", min_gain=0.0 if choice == 3 else None)
