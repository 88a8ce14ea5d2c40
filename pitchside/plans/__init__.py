"""The staging, dimension, fact and mart models, their contracts and the batch run."""
