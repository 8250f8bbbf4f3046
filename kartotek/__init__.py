"""kartotek: Spark jobs for catalogues of statistical datasets."""
