"""Whole runs, the versioned publish, and the registered queries with their oracle SQL."""
