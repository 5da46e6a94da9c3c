from storelens.functions.time import (age_years, day_of, epoch_ms, event_time, format_ts, local_time, parse_ms,
                                      window_bounds)
from storelens.functions.text import comma_tokens, keyword_tokens

__all__ = ["age_years", "day_of", "epoch_ms", "event_time", "format_ts", "local_time", "parse_ms", "window_bounds",
           "comma_tokens", "keyword_tokens"]
