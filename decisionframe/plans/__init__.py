"""Multi-step plans: the build of a training set, and incremental stages."""
