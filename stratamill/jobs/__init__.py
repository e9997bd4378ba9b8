"""The daily jobs: each is a function from input frames to the frame it publishes."""
