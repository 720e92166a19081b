"""Batch operators. A fit is an aggregation job; a transform is a projection or a join."""
