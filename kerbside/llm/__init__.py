"""Operators of a training-data pipeline.

Nothing else in the library imports this subpackage; general helpers of the
library (session, checkpoint folder) may be imported here.
"""
