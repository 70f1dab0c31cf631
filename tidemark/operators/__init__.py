"""DataFrame -> DataFrame transformations, one per table or report."""
