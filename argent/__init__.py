"""Bronze -> silver toolkit on Spark DataFrames.

Sub-packages:
  functions  - column expressions (cleaning, casts, regex checks, masks)
  sources    - bronze scans, driver-table fixtures, the bucketed upsert sink
  operators  - staging steps, merge, SCD2 history, change feeds, checks, governance
  plans      - model specs tying the steps together (one per silver table)
  streaming  - micro-batch forms of the incremental load and the keyed upsert
"""

from argent.session import get_session, work_dir

__all__ = ["get_session", "work_dir"]
