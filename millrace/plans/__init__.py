"""The analytics and pipeline jobs, composed from operators."""
