"""Driver functions that chain the operators into one dataset run."""
