"""Run parameters of the registered queries (the reference's ``:date_ref`` / year literals)."""

import datetime as dt

# cumulative entity tables over order years
FIRST_YEAR = 1995
SCD_CUTOFF = 2000          # full SCD2 build up to this year ...
NEXT_YEAR = 2001           # ... then one incremental step

# daily folds over the event days
RUN_DATE = dt.date(2024, 1, 30)
FOLD_DAYS = 3              # snapshot of RUN_DATE - 3 built in batch, then 3 daily steps

# month arrays: events shifted so that their last day is the run date and the fold crosses a month boundary
MONTH_SHIFT_DAYS = 3
MONTH_RUN_DATE = dt.date(2024, 2, 2)

# history segments: items of a segment (a production table takes thousands)
SEGMENT_ITEMS = 4

# late events: minutes of every hour whose events land after all others
LATE_MINUTES = (30, 32)

# stream de-duplication: the landing folder receives this many time slices, one after the other
LANDING_SLICE_DAYS = 5
