"""Relational building blocks shared by the reports."""

from blotter.operators.key_filter import key_filter, passing, row_hash, with_verdict
from blotter.operators.near_keys import join_near
from blotter.operators.partials import Partials
from blotter.operators.sites import assigned_site, nearest_site, site_locations
from blotter.operators.topn import top_and_bottom_n, top_n_per_group

__all__ = [
    "Partials",
    "assigned_site",
    "join_near",
    "key_filter",
    "nearest_site",
    "passing",
    "row_hash",
    "site_locations",
    "top_and_bottom_n",
    "top_n_per_group",
    "with_verdict",
]
