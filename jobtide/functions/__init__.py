"""Column helpers; every one is a built-in Spark expression."""

from jobtide.functions.classify import (
    categorise,
    days_active,
    is_active,
    is_remote,
    length_bucket,
    searchable,
)
from jobtide.functions.dates import day_of, epoch_to_utc, utc_literal, utc_time
from jobtide.functions.keys import keyed_id, namespaced_id, skipping_concat
from jobtide.functions.text import (
    blank_to_null,
    default_group,
    first_value,
    first_word,
    last_word,
    split_literal,
)
from jobtide.functions.urls import (
    board_company,
    full_link,
    is_full_link,
    normalise_url,
    page_company,
    provider_of,
    token_company,
)

__all__ = [
    "blank_to_null",
    "board_company",
    "categorise",
    "day_of",
    "days_active",
    "default_group",
    "epoch_to_utc",
    "first_value",
    "first_word",
    "full_link",
    "is_active",
    "is_full_link",
    "is_remote",
    "keyed_id",
    "last_word",
    "length_bucket",
    "namespaced_id",
    "normalise_url",
    "page_company",
    "provider_of",
    "searchable",
    "skipping_concat",
    "split_literal",
    "token_company",
]
