"""The TV platform's configuration: categories, app codes, keyword patterns, labels, limits.

`VIEWS` and `SEARCHES` hold all of it. Operators, profiles, jobs and reports take another
`ViewRules` or `SearchRules` as their `rules` argument, so another platform needs no new code.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

# Viewing categories in tie-break order.
WATCH_CATEGORIES = ["Giai_Tri", "Phim_Truyen", "The_Thao", "Thieu_Nhi", "Truyen_Hinh"]

# Search categories in tie-break order.
SEARCH_CATEGORIES = ["TruyenHinh", "TheThao", "ThieuNhi", "Phim", "GiaiTri"]

# App codes of each viewing category (exact, case-sensitive).
APP_CODES = {
    "Truyen_Hinh": ["CHANNEL"],
    "Giai_Tri": ["RELAX"],
    "Thieu_Nhi": ["CHILD"],
    "Phim_Truyen": ["FIMS", "VOD"],
    "The_Thao": ["KPLUS", "SPORT"],
}
# Category of an unlisted app code, contract that is none.
UNKNOWN_APP = "Other"
INVALID_CONTRACT = "0"

# Search patterns over the lower-cased keyword; the first match wins.
KEYWORD_PATTERNS = {
    "TruyenHinh": r"kênh|vtv|htv|channel|trực tiếp|live tv",
    "TheThao": r"bóng đá|u23|u20|ngoại hạng|running man|thể thao|sport|world cup|champion",
    "ThieuNhi": r"siêu nhân|naruto|boruto|fairy tail|doraemon|conan|pokemon|hoạt hình|anime|thiếu nhi",
    "Phim": r"phim|tập \d|season|episode|ep\.|movie|drama",
}
# Fixed value: category of a keyword that no pattern matches.
DEFAULT_KEYWORD = "GiaiTri"

# Activity limits. Viewing is High above the limit, search is High from it on.
WEEK_DAYS = 7
WEEK_LIMIT = 4
MONTH_LIMIT = 15
SEARCH_DAY_LIMIT = 4

# Stand-ins for a missing value.
NO_PLAN = "None"
NO_TASTE = "None"
UNKNOWN = "unknown"

# Quit percentage above which a user is flagged.
HIGH_QUIT_PCT = 30

# Display labels of the reports.
WATCH_LABELS = ["Giải Trí", "Phim Truyện", "Thể Thao", "Thiếu Nhi", "Truyền Hình"]
SEARCH_LABELS = ["Truyền Hình", "Thể Thao", "Thiếu Nhi", "Phim", "Giải Trí"]
ACTIVE_LABELS = ["High Active", "Low Active"]
PLAN_LABELS = ["Có gói cước", "Không có gói"]


@dataclass(frozen=True)
class ViewRules:
    """How views are counted. `categories` is the tie-break order; all keys of `codes` if left out. `titles` are their
    names in charts, in that order."""

    codes: Mapping[str, Sequence[str]]
    categories: Sequence[str] = ()
    unknown_app: str = UNKNOWN_APP
    invalid_contract: str = INVALID_CONTRACT
    no_taste: str = NO_TASTE
    week_days: int = WEEK_DAYS
    week_limit: int = WEEK_LIMIT
    month_limit: int = MONTH_LIMIT
    titles: Sequence[str] = ()

    def __post_init__(self):
        object.__setattr__(self, "categories", list(self.categories or self.codes))
        if set(self.categories) != set(self.codes):
            raise ValueError("categories and codes have to name the same categories")
        object.__setattr__(self, "titles", list(self.titles or self.labels))

    @property
    def labels(self) -> list[str]:
        return [c.replace("_", " ") for c in self.categories]

    @property
    def names(self) -> list[str]:
        """Beginnings of the report columns of each category."""
        return [c.lower() for c in self.categories]


@dataclass(frozen=True)
class SearchRules:
    """How searches are counted. `categories` is the tie-break order; the patterns' keys and `default` if left out."""

    patterns: Mapping[str, str]
    default: str = DEFAULT_KEYWORD
    categories: Sequence[str] = ()
    day_limit: int = SEARCH_DAY_LIMIT
    no_plan: str = NO_PLAN
    unknown: str = UNKNOWN
    high_quit_pct: float = HIGH_QUIT_PCT
    titles: Sequence[str] = ()

    def __post_init__(self):
        known = list(dict.fromkeys([*self.patterns, self.default]))
        object.__setattr__(self, "categories", list(self.categories or known))
        if set(self.categories) != set(known):
            raise ValueError("categories have to be the patterns' and the default")
        object.__setattr__(self, "titles", list(self.titles or self.categories))

    @property
    def names(self) -> list[str]:
        """Report columns of the categories: GiaiTri is giai_tri."""
        return [re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", c).lower() for c in self.categories]


VIEWS = ViewRules(APP_CODES, WATCH_CATEGORIES, titles=WATCH_LABELS)
SEARCHES = SearchRules(KEYWORD_PATTERNS, categories=SEARCH_CATEGORIES, titles=SEARCH_LABELS)
