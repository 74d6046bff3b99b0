"""Training-data operators: licence scan, token files, secret scan, resharding,
decontamination, chat formatting, quality outliers, packing, toxicity and the
n-gram Jaccard join.  Nothing else in the library imports this subpackage."""
