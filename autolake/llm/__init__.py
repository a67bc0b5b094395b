"""Training-data operators for large text corpora (see README, "Training-data operators")."""
