"""Live forms of the funnel and the cells for Structured Streaming."""
