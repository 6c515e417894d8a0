"""The domain tables derived from the TPC-H-like test tables."""
