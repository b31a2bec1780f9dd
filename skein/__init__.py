"""skein — a Spark-native engine for news-style online learning and recommendation.

Events become labelled user–item instances, instances join article profiles of a
sliding window, sparse features are kept in long form, logistic-regression state
is versioned in tables, and ranked top-k lists are published per active user,
in batch and in Structured Streaming micro-batches.
"""

__version__ = "0.1.0"
