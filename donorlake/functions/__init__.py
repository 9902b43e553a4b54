"""Column functions: Column in, Column out, no Python UDFs."""

from donorlake.functions.address import parse_address
from donorlake.functions.amounts import (
    AMOUNT_TYPE,
    add_components,
    clean_amount,
    digits_amount,
    signed_amount,
    to_amount,
    to_int_rounded,
)
from donorlake.functions.dates import (
    date_or_year,
    excel_serial,
    load_time,
    month_of,
    parse_day_month,
    parse_flexible_date,
    parse_ts,
    repair_date,
    safe_parse_date,
    to_ts,
    year_of,
)
from donorlake.functions.keys import (
    committee_id,
    key_if,
    name_concat,
    name_concat_parts,
    surrogate_key,
)
from donorlake.functions.names import cut, flip_name, join_name, title
from donorlake.functions.text import (
    blank_to_null,
    earmark_committee,
    first_match,
    first_present,
    last_part,
    letters_only,
    map_codes,
    pad_left,
    part,
    replace_all,
    replace_first,
    split_pair,
    strip_parens,
    zip5,
)

__all__ = [n for n in dir() if not n.startswith("_")]
