"""The pipeline's models (staging, intermediate, marts) and the work-queue jobs, each a function
from input DataFrames to an output DataFrame. Lineage is plain function composition."""
