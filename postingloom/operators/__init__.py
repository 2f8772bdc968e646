"""DataFrame transformations: normalise, de-duplicate, model, report."""
