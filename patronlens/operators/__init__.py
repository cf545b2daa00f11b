from patronlens.operators.blocks import (
    basic_pair_block,
    month_block,
    pair_block,
    seller_block,
    user_block,
)
from patronlens.operators.fanout import fan_out
from patronlens.operators.labelled import join_log_labels, label_pairs, with_day
from patronlens.operators.relational import (
    attach_left,
    full_outer_chain,
    register_views,
    share_of_total,
)
from patronlens.operators.split import keyed_split, random_split, row_split, with_fold

__all__ = [
    "attach_left",
    "basic_pair_block",
    "fan_out",
    "full_outer_chain",
    "join_log_labels",
    "keyed_split",
    "label_pairs",
    "month_block",
    "pair_block",
    "random_split",
    "register_views",
    "row_split",
    "seller_block",
    "share_of_total",
    "user_block",
    "with_day",
    "with_fold",
]
