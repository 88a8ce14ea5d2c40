"""Micro-batch refresh of posts and the daily sentiment mart."""
