"""rxatlas — prescribing analytics as Spark DataFrame jobs.

Monthly item-level prescribing records are grouped into a partitioned base
table, counted per illness, turned into clipped z-scores and a composite
practice index, and carried to areas (mean over member practices, inverse
distance weighting from the k nearest practices, local similarity score).
"""

__version__ = "0.1.0"
