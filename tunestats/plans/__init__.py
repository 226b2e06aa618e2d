"""Table builders (model, marts), reports and the layer pipeline."""
