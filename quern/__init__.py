"""quern: Spark operators that turn raw text tables into model-ready token tables."""
