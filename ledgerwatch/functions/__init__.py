from ledgerwatch.functions.clean import (  # noqa: F401
    blank_to_null, clean_string, end_ts, epoch_ts, full_name, lit_ts, minus_one_second,
    parse_amount, parse_day, parse_ts, ts_string, epoch_micros, changed,
)
