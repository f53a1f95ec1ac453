"""Marquee: movie-rating curation, analytics and recommendations as Spark jobs.

Every public function takes and returns DataFrames and nothing holds a global session.
Most functions only build a plan. Some run jobs when called, and say so: joins that
measure a dimension before they broadcast it, model fits, and results that are
checkpointed because several others share them.
"""

__version__ = "0.1.0"
