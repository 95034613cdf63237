"""Compositions: the layers of the lakehouse and the jobs that keep them."""
