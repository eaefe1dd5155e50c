"""Ready-made queries over the test tables, and the whole feature-to-portfolio flow."""
