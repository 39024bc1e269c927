"""Full license texts as published, without titles, copyright lines and instructions for use."""
